"""Small batches of keys spread over the whole range of a target."""

import pytest
from pyspark.sql import functions as F

from asterloom.operators import incremental_append, load, load_once, read_loads
from asterloom.sinks import append_rows, overwrite_table
from asterloom.sources import read_table
from tests.helpers import rows

ROWS = 40_000
LOADS = 5


def scanned(df):
    """The rows that come out of the scan of a frame without shuffles."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def numbers(spark, part, kind="bigint"):
    """Distinct keys that are spread over the whole range, whatever the part."""
    ids = spark.range(part, ROWS * LOADS, LOADS, 1)
    key = F.xxhash64("id") if kind == "bigint" else F.sha2(F.col("id").cast("string"), 256)
    return ids.select(key.alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_row_groups_without_the_keys_are_skipped(spark, with_conf, tmp_path, kind):
    # At most eight lists of five keys: 41 are not named.
    with_conf(spark__sql__parquet__pushdown__inFilterThreshold="5")
    assert load._named_keys(numbers(spark, 3, kind).limit(41), "k") is None
    plain, filtered = f"{tmp_path}/plain", f"{tmp_path}/filtered"
    for part in range(LOADS):
        append_rows(numbers(spark, part, kind), plain)
        append_rows(numbers(spark, part, kind), filtered, ["k"])
    batch = numbers(spark, 3, kind).limit(30)
    found = {}
    for path in (plain, filtered):
        wanted = load._named_keys(batch, "k")
        table = read_table(spark, path, ["k"]).filter(wanted)
        assert table.count() == 30
        found[path] = scanned(table)
    # Pages are skipped by their bounds in either, whole row groups only by their filters.
    assert 30 <= found[filtered] <= ROWS * 2
    assert found[plain] > 2 * found[filtered]


@pytest.mark.parametrize("limit", [0, 3, 2000])
@pytest.mark.parametrize("once", [False, True])
def test_same_rows_with_and_without_lookup(spark, tmp_path, monkeypatch, limit, once):
    monkeypatch.setattr(load, "BROADCAST_TARGET_RATIO", 0)
    monkeypatch.setattr(load, "LOOKUP_KEYS", limit)
    schema = "K bigint, `g.x` string, v string"
    old = [(1, "a", "old"), (1, None, "old"), (None, "a", "old"), (None, None, "old"), (7, "", "old")]
    new = [(1, "a", "x"), (1, "b", "n"), (None, None, "x"), (None, "b", "n"), (7, None, "n"),
           (9, "é" * 50, "n"), (9, "é" * 50, "n"), (-(2**63), "z", "n"), (2**63 - 1, "z", "n")]
    target = f"{tmp_path}/t"
    for i, values in enumerate((old, new)):
        batch = spark.createDataFrame(values, schema)
        if once:
            result = load_once(batch, target, str(i), ["k", "g.x"])
        else:
            result = incremental_append(batch, target, ["k", "g.x"])
    assert result == (7, 2)
    table = read_loads(spark, target) if once else read_table(spark, target)
    assert rows(table) == rows(spark.createDataFrame(old + [n for n in new if n[2] == "n"], schema))


def test_keys_that_cannot_be_named(spark, tmp_path, monkeypatch):
    text = spark.sql("SELECT cast(X'FF61' AS string) AS k UNION ALL SELECT 'a' UNION ALL SELECT NULL")
    # Stored, as a literal that is not UTF-8 is changed where Spark pushes it to a scan.
    overwrite_table(text, f"{tmp_path}/batch")
    text = read_table(spark, f"{tmp_path}/batch")
    assert load._named_keys(text, "k") is None
    monkeypatch.setattr(load, "BROADCAST_TARGET_RATIO", 0)
    overwrite_table(text.filter("k = 'a'"), f"{tmp_path}/t", ["k"])
    assert incremental_append(text, f"{tmp_path}/t", ["k"]) == (2, 1)
    assert incremental_append(text, f"{tmp_path}/t", ["k"]) == (0, 3)
    # Columns of other types get no filter, and batches of nulls or without rows name no value.
    dates = spark.sql("SELECT DATE'2024-01-01' AS d, 1Y AS k UNION ALL SELECT NULL, NULL")
    assert incremental_append(dates, f"{tmp_path}/d", ["d", "k"]) == (2, 0)
    assert incremental_append(dates, f"{tmp_path}/d", ["d", "k"]) == (0, 2)
    assert incremental_append(dates.filter("d IS NULL"), f"{tmp_path}/d", ["d", "k"]) == (0, 1)
    assert incremental_append(dates.filter("k = 5"), f"{tmp_path}/d", ["d", "k"]) == (0, 0)
