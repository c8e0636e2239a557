"""Writers. Each returns the number of rows written, counted while writing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.functions import named
from asterloom.sources.readers import SWITCHES, current_version, is_path, version_path

# Types of keys that are looked up by value, for which Parquet keeps Bloom filters.
LOOKUP_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)
# A filter takes some 20 bits per distinct key of a row group, rounded up to a power of two, and
# this many bytes at most. One key in 10,000 that a row group does not have passes its filter.
BLOOM_OPTIONS = {
    "parquet.bloom.filter.adaptive.enabled": "true",
    "parquet.bloom.filter.candidates.number": "10",
    "parquet.bloom.filter.max.bytes": str(8 * 1024 * 1024),
    "parquet.bloom.filter.fpp": "0.0001",
}

# Landed records in a compressed file, at most: no reader can split it.
LANDED_RECORDS = 250_000


def write_observed(
    df: DataFrame, write: Callable[[DataFrame], None], metrics: Mapping[str, Column] = {}
) -> dict[str, int]:
    """Write, and return ``rows`` and the given aggregates from the same pass.

    The observation sits on top of the plan, in the writing stage: a task that is run
    again after a lost executor is counted once.
    """
    observation = Observation()
    counts = [m.alias(name) for name, m in metrics.items()]
    write(df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts))
    return observation.get


def _counted(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    return write_observed(df, write)["rows"]


def write_records(df: DataFrame, path: str) -> int:
    """Replace the raw landing folder: one JSON record per line, in gzip files.

    Field names and quotes are most of such text, so the files take about an eighth of it. Readers
    take each file whole, so none has more than ``LANDED_RECORDS`` records, whatever a task writes.
    """
    options = {"compression": "gzip", "maxRecordsPerFile": LANDED_RECORDS}
    return _counted(df, lambda d: d.write.mode("overwrite").options(**options).json(path))


def _lookup_options(df: DataFrame, lookup: Sequence[str]) -> dict[str, str]:
    """Writer options for Bloom filters on ``lookup``; columns of other types get none.

    Parquet writes none for a column chunk that is stored by dictionary: there readers
    look into the dictionary instead.
    """
    fields = [f for f in df.schema if f.name in lookup and isinstance(f.dataType, LOOKUP_TYPES)]
    chosen = {f"parquet.bloom.filter.enabled#{f.name}": "true" for f in fields}
    return BLOOM_OPTIONS | chosen if chosen else {}


def write_table(df: DataFrame, path: str, lookup: Sequence[str] = ()) -> None:
    """Replace a Parquet table, without a count."""
    options = _lookup_options(df, lookup)
    df.write.mode("overwrite").options(**options).option("compression", "snappy").parquet(path)


def overwrite_table(df: DataFrame, path: str, lookup: Sequence[str] = ()) -> int:
    """Replace a Parquet table; as many files as the plan has partitions."""
    return _counted(df, lambda d: write_table(d, path, lookup))


def overwrite_single_file(df: DataFrame, path: str) -> int:
    """Replace a Parquet table by one snappy file, for small dimensions.

    All rows go to one writer, so this is only for tables that do not grow with the data.
    They are moved by a shuffle. ``coalesce(1)`` would instead pull
    the whole stage in front of it, scans and joins included, into a single task.
    """
    return overwrite_table(df.repartition(1), path)


def replace_safely(
    df: DataFrame, path: str, write: Callable[[DataFrame, str], int] = overwrite_table
) -> int:
    """Replace a table so that readers have the old one until the new one is whole.

    The new version is written beside the current one, by any of the writers above, and then its number is
    added to the table's switches: that is one file, which is there or not. ``read_replaceable`` reads the
    newest version that has one. A writer that fails leaves the old version, and what it wrote is
    replaced by the next one. Two folders take turns, so ``df`` may be read from the current version,
    and a reader that began before one switch can end before the next. One writer at a time.
    """
    spark = df.sparkSession
    version = current_version(spark, path) + 1
    rows = write(df, version_path(path, version))
    switch = spark.createDataFrame([(version,)], "version bigint")
    switch.coalesce(1).write.mode("append").parquet(f"{path}/{SWITCHES}")
    return rows


def _save(df: DataFrame, target: str, mode: str, lookup: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).format("parquet").option("compression", "snappy")
    writer = writer.options(**_lookup_options(df, lookup))
    if is_path(target):
        writer.save(target)
    else:
        writer.saveAsTable(target)


def by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in ranges of the keys, sorted in each; adaptive execution sets their number."""
    order = [named(k) for k in keys]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def create_if_absent(df: DataFrame, target: str) -> None:
    """Create an empty target with the columns of ``df``; an existing one is left alone."""
    _save(df.limit(0), target, "ignore")


def append_rows(df: DataFrame, target: str, lookup: Sequence[str] = ()) -> int:
    """Append to a Parquet path or a catalog table; it is created if absent.

    Row groups get Bloom filters on the columns of ``lookup``.
    """
    return _counted(df, lambda d: _save(d, target, "append", lookup))
