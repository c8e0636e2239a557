"""Invariants over generated records."""

from collections import Counter
from unittest.mock import patch

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from asterloom.operators import (
    build_fact,
    build_fact_from_arrays,
    clean,
    incremental_append,
    left_join_children,
    load,
    split_array,
)
from asterloom.plans import movies as m
from asterloom.sinks import append_rows, new_scratch_dir
from asterloom.sources import read_table

from tests.helpers import records

few = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
ids = st.one_of(st.none(), st.integers(0, 5))
raw = st.lists(
    st.fixed_dictionaries(
        {
            "id": ids,
            "title": st.sampled_from([None, "", " a ", "b"]),
            "genre_ids": st.one_of(st.none(), st.lists(st.sampled_from([None, 28, 12, 7]), max_size=4)),
            "release_date": st.sampled_from([None, "", "2024", "2024-02-30", "2024-02-29"]),
            "vote_count": st.integers(0, 3),
        }
    ),
    max_size=25,
)
keys = st.lists(st.tuples(ids, ids), max_size=20)


@few
@given(raw)
def test_cleaning_and_modelling(spark, data):
    cleaned = clean(records(spark, *data), [m.KEY], m.REQUIRED, m.TRIMMED)
    parent, bridge = split_array(cleaned, m.KEY, m.ARRAY, m.PARENT_KEY, m.ELEMENT)
    kept = cleaned.collect()
    complete = {r["id"] for r in data if r["id"] is not None and r["title"] is not None}
    assert Counter(r["id"] for r in kept) == Counter(complete)
    assert all(r["title"] == r["title"].strip(" ") for r in kept)

    fact = build_fact(parent, bridge, m.FACT).collect()
    assert Counter(fact) == Counter(build_fact_from_arrays(cleaned, m.ARRAY, m.FACT).collect())
    assert {r["movie_id"] for r in fact} == complete
    expected = Counter()
    for r in kept:
        found = [g for g in r["genre_ids"] or [] if g is not None]
        expected.update((r["id"], g) for g in found or [None])
    assert Counter((r["movie_id"], r["genre_id"]) for r in fact) == expected


@few
@given(keys, keys, st.booleans())
def test_incremental_append(spark, stored, batch, small):
    schema, target = "a bigint, b bigint", new_scratch_dir(spark, "property")
    append_rows(spark.createDataFrame(stored, schema), target)
    fresh = [k for k in batch if k not in set(stored)]
    with patch.object(load, "BROADCAST_TARGET_RATIO", 0):
        result = incremental_append(
            spark.createDataFrame(batch, schema), target, ["a", "b"], (64 << 20) if small else -1
        )
    assert result == (len(fresh), len(batch) - len(fresh))
    after = Counter(map(tuple, read_table(spark, target).collect()))
    assert after == Counter(stored) + Counter(fresh)


@few
@given(keys, keys)
def test_left_join_children(spark, parents, children):
    """Null and repeated keys on both sides."""
    joined = left_join_children(
        spark.createDataFrame(parents, "p bigint, x bigint"),
        spark.createDataFrame(children, "c bigint, y bigint"),
        "p",
        "c",
    )
    expected = Counter()
    for key, x in parents:
        found = [row for row in children if key is not None and row[0] == key]
        expected.update((key, x, *row) for row in found or [(None, None)])
    assert Counter(map(tuple, joined.collect())) == expected
