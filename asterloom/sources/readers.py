"""Readers for the raw, processed and warehouse layers."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.functions import named

CORRUPT_COLUMN = "_corrupt_record"
# The folder of a replaceable table in which each finished version leaves its number.
SWITCHES = "switches"


def read_records(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str | None = None,
    multiline: bool = True,
) -> DataFrame:
    """Read raw JSON records.

    ``multiline=True`` reads files that each hold one JSON array (or one object) over
    several lines. Such a file is read by one task whatever its size, so the landing
    sink writes one record per line instead, in files of bounded length; read that with
    ``multiline=False``, which splits plain files freely and takes compressed ones whole.
    Without a schema Spark infers one with an extra pass.
    """
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(paths if isinstance(paths, str) else list(paths))


def page_schema(record: T.StructType) -> T.StructType:
    """Envelope of one page: its number, its records, and the text if it is malformed."""
    return (
        T.StructType()
        .add("page", T.LongType())
        .add("results", T.ArrayType(record))
        .add(CORRUPT_COLUMN, T.StringType())
    )


def read_pages(
    spark: SparkSession,
    paths: str | Sequence[str],
    record: T.StructType,
    multiline: bool = True,
) -> DataFrame:
    """Read page envelopes, one per file (``multiline``) or one per line.

    Several paths are read as one bag of pages; nothing is de-duplicated.
    """
    return (
        spark.read.schema(page_schema(record))
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(paths if isinstance(paths, str) else list(paths))
    )


def _is_broken() -> Column:
    # A page with one badly typed field also fills the corrupt column, but what could be
    # read of it is there; of a page that is no JSON nothing is.
    unread = F.col("page").isNull() & F.col("results").isNull()
    return named(CORRUPT_COLUMN).isNotNull() & unread


def flatten_pages(pages: DataFrame) -> DataFrame:
    """One row per record of each page.

    A page without ``results`` or with an empty list gives no row; a broken page is
    skipped and all others are kept.
    """
    return pages.filter(~_is_broken()).select(F.inline("results"))


def page_report(pages: DataFrame) -> DataFrame:
    """One row: pages read, broken pages among them, records in the good ones."""
    return pages.agg(*[metric.alias(name) for name, metric in page_metrics().items()])


def page_metrics() -> dict[str, Column]:
    """The aggregates of the page report, to be counted in a pass over the pages."""
    records = F.when(_is_broken() | F.col("results").isNull(), 0).otherwise(F.size("results"))
    return {
        "pages": F.count(F.lit(1)),
        "broken_pages": F.count_if(_is_broken()),
        "records": F.coalesce(F.sum(records), F.lit(0)).cast("bigint"),
    }


def read_table(
    spark: SparkSession, path: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Read a layer's Parquet table, reduced to ``columns`` if they are given."""
    table = spark.read.parquet(path)
    return table if columns is None else table.select(*[named(c) for c in columns])


def literal_table(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A small constant table."""
    return spark.createDataFrame(list(rows), schema)


def is_path(target: str) -> bool:
    """Targets with a slash are storage paths, others are catalog table names."""
    return "/" in target


def read_target(spark: SparkSession, target: str) -> DataFrame | None:
    """The target table, or None if its folder holds no file yet.

    Any other failure, a missing target among them, is raised: taking it for an empty
    table would append rows that are already loaded.
    """
    if not is_path(target):
        return spark.table(target)
    try:
        return spark.read.parquet(target)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet files at a path, None if there is no such folder or no file in it."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def current_version(spark: SparkSession, path: str) -> int:
    """The number of a replaceable table's newest version, 0 before the first one."""
    switches = read_if_present(spark, f"{path}/{SWITCHES}")
    return 0 if switches is None else switches.agg(F.max("version")).first()[0]


def version_path(path: str, version: int) -> str:
    """Where a version is: two folders take turns."""
    return f"{path}/slot={version % 2}"


def read_replaceable(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of a table that ``replace_safely`` has written."""
    version = current_version(spark, path)
    if version == 0:
        raise ValueError(f"no version of {path!r} was finished yet")
    return spark.read.parquet(version_path(path, version))


def target_keys(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """Keys already in the target; the scan reads the key columns only."""
    table = read_target(spark, target)
    if table is None:
        raise ValueError(f"target {target!r} holds no file")
    return table.select(*[named(k) for k in keys])
