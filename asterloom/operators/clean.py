"""Cleaning: one valid record per key, trimmed text, array columns split off."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.functions import named, trimmed

_RANK = "__asterloom_rank"


def _has_order(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _has_order(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_has_order(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def keep_one(
    df: DataFrame,
    key: Sequence[str],
    prefer: Sequence[str] = (),
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Keep one row per key; null keys form one group.

    The survivor is the first row with a non-null value in each ``prefer`` column, then
    the smallest by ``tie_break`` (nulls last). By default all other columns break
    ties, so the result depends on neither the input order nor re-run tasks. Map and
    variant columns have no order and are left out: copies that differ in nothing else
    may be chosen either way.

    ``row_number() = 1`` is planned as a group limit in front of the shuffle as well as
    behind it: however many copies a key has, each task sends on at most one of them.
    """
    if tie_break is None:
        tie_break = [f.name for f in df.schema if f.name not in key and _has_order(f.dataType)]
    order = [named(c).isNull().asc() for c in prefer]
    order += [named(c).asc_nulls_last() for c in tie_break]
    window = Window.partitionBy(*[named(k) for k in key]).orderBy(*(order or [F.lit(0)]))
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which none of ``columns`` is null."""
    return df.filter(reduce(and_, [named(c).isNotNull() for c in columns]))


def map_columns(
    df: DataFrame, columns: Sequence[str], function: Callable[[Column], Column]
) -> DataFrame:
    """Replace each named column by a function of it, all in one projection."""
    return df.withColumns({c: function(named(c)) for c in columns})


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim the named text columns."""
    return map_columns(df, columns, trimmed)


def drop_column(df: DataFrame, column: str) -> DataFrame:
    """All columns but one."""
    return df.drop(column)


def clean(
    df: DataFrame,
    key: Sequence[str],
    required: Sequence[str],
    trim: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """One record per key, with all ``required`` columns present, and text trimmed.

    A complete copy of a record is preferred to an incomplete one. Filtering first and
    then keeping one copy gives just that, and lets the filter reach the scan and
    shrink the shuffle. Blank text counts as present: it is trimmed after the filter.
    """
    complete = require_columns(df, required)
    return trim_columns(keep_one(complete, key, tie_break=tie_break), trim)


def rejects(df: DataFrame, key: Sequence[str], required: Sequence[str]) -> DataFrame:
    """What ``clean`` leaves out and why: the key, ``reason`` and ``n_rows``, which add up to its removed rows.

    The reason is ``no <column>`` for the first of ``required`` that is null, in their order, and
    ``copy`` for the complete rows of a key beyond the one that is kept. Null keys form one group,
    as there. Rows are counted per key and reason in front of the one shuffle, so a hot key
    costs what any other does. Keys named like an added column are an error.
    """
    if taken := {"reason", "n_rows"} & {k.lower() for k in key}:
        raise ValueError(f"key columns named like added ones: {', '.join(sorted(taken))}")
    missing = [F.when(named(c).isNull(), F.lit(f"no {c}")) for c in required]
    reason = F.coalesce(*missing, F.lit("copy")).alias("reason")
    keys = [named(k).alias(k) for k in key]
    counted = df.select(*keys, reason).groupBy(*[named(k) for k in key], "reason")
    kept = F.when(F.col("reason") == "copy", 1).otherwise(0)
    left_out = counted.agg((F.count(F.lit(1)) - F.max(kept)).alias("n_rows"))
    return left_out.filter("n_rows > 0")


def split_array(
    df: DataFrame, key: str, array: str, parent_key: str, element: str
) -> tuple[DataFrame, DataFrame]:
    """Split a nested record set into its parent table and a bridge table.

    The parent keeps every column but the array. The bridge has one row per non-null
    array element; null and empty arrays give none, repeated elements stay.
    """
    bridge = df.select(
        named(key).alias(parent_key), F.explode(named(array)).alias(element)
    ).filter(named(element).isNotNull())
    return drop_column(df, array), bridge
