"""Tasks that fail and are run again change neither rows nor counts."""

from pyspark import TaskContext

from asterloom.operators import incremental_append, keep_one
from asterloom.sinks import overwrite_table
from asterloom.sources import read_table

from tests.helpers import rows


def _fail_late_once(batches):
    """Pass all rows on, then fail the first attempt."""
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost on purpose")


def flaky(df):
    return df.mapInPandas(_fail_late_once, df.schema)


def test_count_of_a_write(spark, tmp_path):
    df = flaky(spark.range(0, 1000, 1, 4))
    assert overwrite_table(df, str(tmp_path / "t")) == 1000
    assert read_table(spark, str(tmp_path / "t")).distinct().count() == 1000


def test_count_behind_a_shuffle(spark, tmp_path):
    numbers = spark.range(0, 1000, 1, 4).selectExpr("id % 100 AS k", "id AS v")
    path = str(tmp_path / "t")
    assert overwrite_table(flaky(keep_one(flaky(numbers), ["k"])), path) == 100
    assert rows(read_table(spark, path)) == [(i, i) for i in range(100)]


def test_load(spark, tmp_path):
    target = str(tmp_path / "t")
    assert incremental_append(spark.range(0, 50), target, ["id"]) == (50, 0)
    assert incremental_append(flaky(spark.range(0, 90, 1, 4)), target, ["id"]) == (40, 50)
    assert rows(read_table(spark, target)) == [(i,) for i in range(90)]
