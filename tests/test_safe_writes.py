"""Loads that are tried again, and replacements that fail."""

import pytest
from pyspark.sql import functions as F

from asterloom.operators import LoadResult, ledger, load_once, read_loads
from asterloom.operators import load
from asterloom.sinks import overwrite_single_file, replace_safely, write_records
from asterloom.sources import read_records, read_replaceable
from tests.helpers import rows

SCHEMA = "k bigint, g bigint, v string"
FIRST = [(1, 1, "a"), (2, None, "b"), (2, None, "b2")]
SECOND = [(1, 1, "changed"), (2, None, "changed"), (3, 2, "c"), (3, 2, "c2"), (None, None, "n")]


def frame(spark, values, schema=SCHEMA):
    return spark.createDataFrame(values, schema)


def test_a_load_counts_once(spark, tmp_path):
    target = f"{tmp_path}/t"
    assert read_loads(spark, target) is None and ledger(spark, target).count() == 0
    for _ in range(3):
        assert load_once(frame(spark, FIRST), target, "one") == LoadResult(3, 0)
        assert load_once(frame(spark, SECOND), target, "two", ["K", "g"]) == LoadResult(3, 2)
    assert rows(read_loads(spark, target)) == rows(frame(spark, [*FIRST, *SECOND[2:]]))
    # Without a key everything is loaded, but under one id only once.
    for _ in range(2):
        load_once(frame(spark, SECOND), target, "three")
    assert read_loads(spark, target).count() == 11
    assert rows(ledger(spark, target)) == [("one", 3, 0), ("three", 5, 0), ("two", 3, 2)]


@pytest.mark.parametrize("keys", [(), ("k", "g")])
def test_killed_between_rows_and_ledger(spark, tmp_path, monkeypatch, keys):
    target = f"{tmp_path}/t"
    load_once(frame(spark, FIRST), target, "one")

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(load, "overwrite_single_file", killed)
    with pytest.raises(KeyboardInterrupt):
        load_once(frame(spark, SECOND), target, "two", keys)
    monkeypatch.setattr(load, "overwrite_single_file", overwrite_single_file)
    assert rows(read_loads(spark, target)) == rows(frame(spark, FIRST))
    # Another load in between does not see the rows of the broken one.
    assert load_once(frame(spark, [(3, 2, "mine")]), target, "between", keys) == LoadResult(1, 0)
    again = load_once(frame(spark, SECOND), target, "two", keys)
    assert again == (LoadResult(1, 4) if keys else LoadResult(5, 0))
    assert load_once(frame(spark, SECOND), target, "two", keys) == again
    assert read_loads(spark, target).count() == 3 + 1 + again.loaded


def test_killed_while_rows_are_written(spark, tmp_path):
    target = f"{tmp_path}/t"
    load_once(frame(spark, FIRST), target, "one")
    bad = frame(spark, SECOND).withColumn("v", F.when(F.col("k") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="lost"):
        load_once(bad, target, "two", ["k", "g"])
    assert rows(read_loads(spark, target)) == rows(frame(spark, FIRST))
    assert load_once(frame(spark, SECOND), target, "two", ["k", "g"]) == LoadResult(3, 2)
    assert read_loads(spark, target).count() == 6


def test_empty_loads_other_spelling_and_bad_ids(spark, tmp_path):
    target = f"{tmp_path}/t"
    assert load_once(frame(spark, []), target, "none", ["k"]) == LoadResult(0, 0)
    assert load_once(frame(spark, [("x", 1, 5)], "V string, K bigint, G bigint"), target, "one", ["k"]) == LoadResult(1, 0)
    assert rows(read_loads(spark, target), "k", "g", "v") == [(1, 5, "x")]
    with pytest.raises(ValueError, match="differ in columns"):
        load_once(frame(spark, [(1,)], "k bigint"), target, "two", ["k"])
    for bad in ("", "a/b", "a b", "*"):
        with pytest.raises(ValueError, match="load id"):
            load_once(frame(spark, FIRST), target, bad)


def test_a_failing_writer_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(ValueError, match="no version"):
        read_replaceable(spark, path)
    assert replace_safely(frame(spark, FIRST), path) == 3
    bad = frame(spark, SECOND).select("k", "g", F.when(F.col("k") == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("v")).alias("v"))
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            replace_safely(bad, path)
        assert rows(read_replaceable(spark, path)) == rows(frame(spark, FIRST))
    assert replace_safely(frame(spark, SECOND), path) == 5
    assert rows(read_replaceable(spark, path)) == rows(frame(spark, SECOND))
    # From the table itself, into one file.
    assert replace_safely(read_replaceable(spark, path).filter("k = 3"), path, overwrite_single_file) == 2
    assert len(read_replaceable(spark, path).inputFiles()) == 1


def test_any_writer_can_be_made_safe(spark, tmp_path):
    path = f"{tmp_path}/t"
    replace_safely(frame(spark, FIRST), path, write_records)
    assert read_records(spark, f"{path}/slot=1", SCHEMA, multiline=False).count() == 3
