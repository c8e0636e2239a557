import datetime as dt

import pytest

from asterloom.operators import (
    build_fact,
    build_fact_from_arrays,
    clean,
    date_dimension,
    entity_dimension,
    keep_one,
    metrics_row,
    orphans,
    rejects,
    require_columns,
    require_non_empty,
    row_count,
    split_array,
    static_dimension,
    trim_columns,
)
from asterloom.plans import movies as m
from pyspark.sql import functions as F

from tests.helpers import EDGE_ROWS, records, rows

IMAGES = "https://images.example.org/w500"


@pytest.fixture(params=["as given", "reversed, spread"])
def raw(spark, request):
    if request.param == "as given":
        return records(spark, *EDGE_ROWS)
    return records(spark, *reversed(EDGE_ROWS)).repartition(5)


@pytest.fixture
def cleaned(raw):
    return clean(raw, [m.KEY], m.REQUIRED, m.TRIMMED)


@pytest.fixture
def split(cleaned):
    return split_array(cleaned, m.KEY, m.ARRAY, m.PARENT_KEY, m.ELEMENT)


def test_clean_keeps_one_complete_trimmed_record_per_id(cleaned):
    assert rows(cleaned, "id", "title", "original_title") == [
        (1, "A", None),
        (2, "", "\tB\n"),
        (3, "C", None),
        (4, "D", None),
        (5, "E", None),
    ]


def test_clean_is_keep_one_then_require_then_trim(raw, cleaned):
    steps = keep_one(raw, [m.KEY], prefer=["title"])
    steps = trim_columns(require_columns(steps, m.REQUIRED), m.TRIMMED)
    assert rows(steps, "id", "title", "release_date") == rows(
        cleaned, "id", "title", "release_date"
    )


def test_null_keys_form_one_group(raw):
    kept = keep_one(raw, [m.KEY], prefer=["title"])
    assert rows(kept, "id", "title")[0] == (None, "n")
    assert kept.count() == 6


def test_survivor_follows_the_tie_break(spark):
    df = spark.createDataFrame(
        [(1, "b", 1), (1, "a", 2), (1, None, 0), (2, None, 5)], "k int, t string, n int"
    )
    assert rows(keep_one(df, ["k"])) == [(1, "a", 2), (2, None, 5)]
    assert rows(keep_one(df, ["k"], tie_break=["n"])) == [(1, None, 0), (2, None, 5)]
    assert rows(keep_one(df, ["k"], prefer=["t"], tie_break=["n"])) == [(1, "b", 1), (2, None, 5)]


def test_keep_one_skips_columns_without_an_order(spark):
    df = spark.createDataFrame(
        [(1, {"a": 1}, [2]), (1, {"b": 1}, [1])], "k int, props map<string,int>, list array<int>"
    )
    assert keep_one(df, ["k"]).first()["list"] == [1]


def test_keep_one_on_several_keys_and_odd_names(spark):
    df = spark.createDataFrame([(1, 2, "x"), (1, 2, "y"), (1, 3, "z")], ["a.b", "c d", "v"])
    assert rows(keep_one(df, ["a.b", "c d"])) == [(1, 2, "x"), (1, 3, "z")]


def test_split(split):
    parent, bridge = split
    assert m.ARRAY not in parent.columns
    assert parent.count() == 5
    assert rows(bridge) == [(1, 12), (1, 12), (1, 28), (4, 99999), (5, 28)]


@pytest.mark.parametrize("joined", [True, False])
def test_fact(cleaned, split, joined):
    fact = (
        build_fact(*split, m.FACT) if joined else build_fact_from_arrays(cleaned, m.ARRAY, m.FACT)
    )
    assert fact.dtypes == [
        ("movie_id", "bigint"),
        ("genre_id", "bigint"),
        ("date_id", "date"),
        ("popularity", "double"),
        ("vote_average", "double"),
        ("vote_count", "int"),
    ]
    assert rows(fact, "movie_id", "genre_id", "date_id") == [
        (1, 12, dt.date(2024, 1, 2)),
        (1, 12, dt.date(2024, 1, 2)),
        (1, 28, dt.date(2024, 1, 2)),
        (2, None, None),
        (3, None, dt.date(2024, 1, 1)),
        (4, 99999, None),
        (5, 28, dt.date(2024, 5, 3)),
    ]


def test_fact_keeps_parents_without_key(spark):
    parent = records(spark, dict(id=None, title="x", popularity=1.5), dict(id=1, title="y"))
    bridge = spark.createDataFrame([(1, 28), (None, 12), (7, 12)], "movie_id bigint, genre_id bigint")
    fact = build_fact(parent.drop(m.ARRAY), bridge, m.FACT)
    assert rows(fact, "movie_id", "genre_id", "popularity") == [(None, None, 1.5), (1, 28, None)]


def test_vote_count_overflow(spark):
    from dataclasses import replace

    df = records(spark, dict(id=1, title="x", vote_count=2**31 + 5))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        build_fact_from_arrays(df, m.ARRAY, m.FACT).collect()
    spec = replace(m.FACT, overflow="null")
    assert build_fact_from_arrays(df, m.ARRAY, spec).first()["vote_count"] is None


def test_date_dimension(cleaned):
    assert rows(date_dimension(cleaned, "release_date")) == [
        (dt.date(2024, 1, 1), "2024", "1", "1"),
        (dt.date(2024, 1, 2), "2024", "1", "2"),
        (dt.date(2024, 5, 3), "2024", "5", "3"),
    ]


def test_entity_dimension(spark):
    df = records(
        spark,
        dict(id=1, title="x", poster_path="/p.jpg", release_date="2024", adult=True),
        dict(id=2, title="y", release_date="nope", backdrop_path="/b.jpg", video=False),
    )
    entity = entity_dimension(df, m.entity_spec(IMAGES))
    assert entity.dtypes == [
        ("movie_id", "bigint"),
        ("title", "string"),
        ("original_title", "string"),
        ("original_language", "string"),
        ("poster_url", "string"),
        ("poster_path", "string"),
        ("backdrop_path", "string"),
        ("release_date", "date"),
        ("adult", "boolean"),
        ("video", "boolean"),
    ]
    assert rows(entity) == [
        (1, "x", None, None, IMAGES + "/p.jpg", "/p.jpg", None, dt.date(2024, 1, 1), True, None),
        (2, "y", None, None, None, None, "/b.jpg", None, None, False),
    ]


def test_static_dimension_and_orphans(spark, cleaned):
    genres = static_dimension(spark, m.GENRES, m.GENRE_SCHEMA)
    assert genres.count() == 18
    fact = build_fact_from_arrays(cleaned, m.ARRAY, m.FACT)
    assert rows(orphans(fact, genres, m.ELEMENT)) == [(99999, 1)]


def test_quality(raw, cleaned, split):
    one = F.count(F.lit(1))
    metrics = metrics_row(
        (raw, {"raw": one}), (cleaned, {"clean": one}), (split[1], {"bridge": one})
    )
    assert rows(metrics) == [(8, 5, 5)]
    assert row_count(raw) == 8


def test_guard(spark, raw):
    assert require_non_empty(raw) is raw
    with pytest.raises(ValueError, match="pages has no rows"):
        require_non_empty(raw.limit(0), "pages")


def test_rejects_add_up_to_what_is_removed(spark, raw):
    found = rejects(raw, [m.KEY], m.REQUIRED)
    assert rows(found) == [(None, "no id", 2), (1, "no title", 1)]
    copies = raw.union(raw).union(raw)
    found = rejects(copies, [m.KEY], m.REQUIRED)
    removed = copies.count() - clean(copies, [m.KEY], m.REQUIRED, m.TRIMMED).count()
    assert found.agg(F.sum("n_rows")).first()[0] == removed
    assert (1, "copy", 2) in rows(found) and (1, "no title", 3) in rows(found)
    # Without the key among the required columns its nulls are a group, of which one row stays.
    found = rejects(copies, [m.KEY], ["title"])
    assert (None, "copy", 5) in rows(found)
    assert rejects(raw.limit(0), [m.KEY], m.REQUIRED).count() == 0


def test_rejects_name_the_first_missing_column(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (1, "a", None, "x")], "k int, `a.b` string, c string, reason string")
    assert rows(rejects(df, ["k"], ["a.b", "c"])) == [(1, "no a.b", 1), (1, "no c", 1)]
    with pytest.raises(ValueError):
        rejects(df, ["k", "reason"], ["c"])
