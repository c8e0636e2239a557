"""Incremental loading: append only the rows whose key the target does not have yet."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.functions import named
from asterloom.sinks.writers import (
    LOOKUP_TYPES,
    append_rows,
    by_key,
    create_if_absent,
    overwrite_single_file,
    overwrite_table,
)
from asterloom.sources.readers import read_if_present, read_target

# Keys of a batch up to this size are sent to all executors.
BROADCAST_KEY_BYTES = 64 * 1024 * 1024
# What a row costs in a broadcast hash table besides its key text, rounded up.
_ROW_OVERHEAD = 64
# The target is worth a broadcast if it has at least this many rows per row of the
# batch. Below, shuffling its keys costs no more than shuffling the batch.
BROADCAST_TARGET_RATIO = 4

# A batch with this many distinct keys at most names them to the target's scan. Each is one
# value on the driver and in the plan. With more, most row groups have one or pass by chance.
LOOKUP_KEYS = 2000
# Lists that name them, at most: each goes through a row group's dictionary anew. How many keys
# a list has is the session's setting below; Spark turns longer lists into a range.
LOOKUP_LISTS = 8
_LIST_SETTING = "spark.sql.parquet.pushdown.inFilterThreshold"

# Key types whose values can be fetched and compared safely. Dates
# are left out: Spark's reach beyond the years that Python can hold. Text is used only
# where what is fetched is valid UTF-8: other bytes do not survive the way through Python.
_RANGE_TYPES = LOOKUP_TYPES

# Folders of a target that is loaded with a ledger.
_ROWS, _LEDGER = "rows", "ledger"
_LEDGER_SCHEMA = "load_id string, loaded bigint, skipped bigint"


class LoadResult(NamedTuple):
    loaded: int
    skipped: int


def _same_keys(keys: Sequence[str]) -> Column:
    return reduce(and_, [named(k, "n").eqNullSafe(named(k, "e")) for k in keys])


def _keys_of(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[named(k) for k in keys])


def new_rows(
    batch: DataFrame, existing: DataFrame, keys: Sequence[str], small: bool = False
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``; a null key equals a null key.

    Rows that share a new key are all kept. Existing keys are made distinct in front of
    the join, so repeated ones are reduced before they are shuffled; a hot key of the
    batch is left to adaptive execution, which splits the left side of an anti join.

    ``small`` says that the batch's keys are known to fit a broadcast. Then the target
    is not shuffled: it is narrowed to the batch's keys where it is scanned, and what is
    left, at most one row per batch key, is broadcast to the batch.
    """
    known = _keys_of(existing, keys)
    if small:
        wanted = F.broadcast(_keys_of(batch, keys).distinct())
        known = known.alias("e").join(wanted.alias("n"), _same_keys(keys), "left_semi")
        known = F.broadcast(known.distinct())
    else:
        known = known.distinct()
    return batch.alias("n").join(known.alias("e"), _same_keys(keys), "left_anti")


def _ranged(batch: DataFrame, existing: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys whose range in the batch can narrow the scan of the target."""
    return [
        k
        for k in keys
        if isinstance(batch.schema[k].dataType, _RANGE_TYPES)
        and batch.schema[k].dataType == existing.schema[k].dataType
    ]


def _within_range(existing: DataFrame, ranges: Mapping[str, tuple]) -> DataFrame:
    """Drop target rows outside the batch's key ranges; the condition reaches the scan,
    which skips row groups by their statistics."""
    for key, bounds in ranges.items():
        if bounds is None:
            continue
        low, high = bounds
        inside = named(key).isNull()
        if low is not None:
            inside = inside | named(key).between(F.lit(low), F.lit(high))
        existing = existing.filter(inside)
    return existing


def _bounds(batch: DataFrame, key: str) -> Column:
    """The smallest and largest key, null if they cannot be fetched safely."""
    low, high = F.min(named(key)), F.max(named(key))
    bounds = F.struct(low, high)
    if isinstance(batch.schema[key].dataType, T.StringType):
        safe = F.coalesce(F.is_valid_utf8(low) & F.is_valid_utf8(high), F.lit(True))
        bounds = F.when(safe, bounds)
    return bounds.alias(f"range_{key}")


def _lookup_list(batch: DataFrame) -> tuple[int, int]:
    """How many keys a list may have, and how many of them can be named in all."""
    length = int(batch.sparkSession.conf.get(_LIST_SETTING))
    return length, min(LOOKUP_KEYS, LOOKUP_LISTS * length)


def _named_keys(batch: DataFrame, key: str) -> Column | None:
    """A condition on the target that names the batch's values of ``key`` in lists which reach the scan.

    None if there are more than can be named, or text that is not UTF-8.
    """
    length, most = _lookup_list(batch)
    value, valid = named(key), F.lit(True)
    if isinstance(batch.schema[key].dataType, T.StringType):
        value, valid = F.make_valid_utf8(value), F.coalesce(F.is_valid_utf8(value), valid)
    found = batch.select(named(key)).distinct().select(value.alias("value"), valid.alias("valid"))
    found = found.limit(most + 1).collect()
    if len(found) > most or not all(row.valid for row in found):
        return None
    values = sorted(row.value for row in found if row.value is not None)
    lists = [values[i : i + length] for i in range(0, len(values), max(1, length))]
    conditions = [named(key).isin(some) for some in lists]
    # A search for nulls passes every Bloom filter, so it is left out where it can be.
    if len(values) < len(found):
        conditions.append(named(key).isNull())
    return reduce(or_, conditions, F.lit(False))


def _aligned(batch: DataFrame, target: DataFrame) -> DataFrame:
    """Batch columns in the target's order and spelling; names match case-insensitively."""
    mine = {f.name.lower(): f for f in batch.schema}
    theirs = {f.name.lower(): f for f in target.schema}
    wrong = sorted(mine.keys() ^ theirs.keys()) + [
        name
        for name, field in theirs.items()
        if name in mine and mine[name].dataType.simpleString() != field.dataType.simpleString()
    ]
    if wrong:
        raise ValueError(f"batch and target differ in columns: {', '.join(wrong)}")
    return batch.select(*[named(mine[n].name).alias(f.name) for n, f in theirs.items()])


def incremental_append(
    batch: DataFrame,
    target: str,
    keys: Sequence[str] = (),
    broadcast_key_bytes: int = BROADCAST_KEY_BYTES,
) -> LoadResult:
    """Append the rows of ``batch`` with keys new to ``target``; return (loaded, skipped).

    * No key: append everything, nothing is skipped.
    * Target missing or empty: create it if need be and load everything.
    * Otherwise rows with known keys are skipped. Stored rows are never updated, the
      first version seen stays; rows of one batch that share a new key are all loaded.

    What is appended is ordered by key and written in files of the size that adaptive
    execution aims at, so a small load leaves one file, and later loads skip the files
    and row groups whose keys they do not have: by the range of the batch's keys and, if these are
    few, by Bloom filters on the key columns, which also tell row groups apart that all span the
    whole range. Few are ``LOOKUP_LISTS`` times ``spark.sql.parquet.pushdown.inFilterThreshold``
    (80 unless set; ``conf/cluster.conf`` sets it), and ``LOOKUP_KEYS`` at most.

    The target's keys are shuffled only if the batch's keys take more than
    ``broadcast_key_bytes`` or the target is hardly larger than the batch.

    ``target`` is a Parquet path (with a slash) or a catalog table. The batch is read
    more than once, so pass a stored table. One writer at a time: the append is not
    atomic with the read of the keys.
    """
    spark = batch.sparkSession
    create_if_absent(batch, target)
    existing = read_target(spark, target)
    target_rows = 0
    if existing is not None:
        batch = _aligned(batch, existing)
    spelled = {c.lower(): c for c in batch.columns}
    keys = [spelled[k.lower()] for k in keys]
    if existing is not None:
        # Parquet answers this from its footers.
        target_rows = existing.count() if keys else 0
    if not target_rows:
        return LoadResult(append_rows(by_key(batch, keys) if keys else batch, target, keys), 0)
    fresh, rows = _fresh(batch, existing, keys, target_rows, broadcast_key_bytes)
    loaded = append_rows(by_key(fresh, keys), target, keys)
    return LoadResult(loaded, rows - loaded)


def _fresh(
    batch: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    target_rows: int,
    broadcast_key_bytes: int,
) -> tuple[DataFrame, int]:
    """The batch's rows with keys new to the target, and how many rows the batch has."""
    key_bytes = sum(
        (F.coalesce(F.octet_length(named(k).cast("string")), F.lit(0)) for k in keys),
        F.lit(_ROW_OVERHEAD),
    )
    ranged = _ranged(batch, existing, keys)
    size = batch.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(key_bytes.cast("bigint")), F.lit(0)).alias("key_bytes"),
        *[_bounds(batch, k) for k in ranged],
        *[F.approx_count_distinct(named(k)).alias(f"distinct_{k}") for k in ranged],
    ).first()

    existing = _within_range(existing, {k: size[f"range_{k}"] for k in ranged})
    small = (
        size["key_bytes"] <= broadcast_key_bytes
        and size["rows"] * BROADCAST_TARGET_RATIO <= target_rows
    )
    few = [k for k in ranged if size[f"distinct_{k}"] <= _lookup_list(batch)[1]]
    if small and few:
        # The key with the most values tells the row groups apart best.
        wanted = _named_keys(batch, max(few, key=lambda k: size[f"distinct_{k}"]))
        existing = existing if wanted is None else existing.filter(wanted)
    return new_rows(batch, existing, keys, small), size["rows"]


def load_once(
    batch: DataFrame,
    target: str,
    load_id: str,
    keys: Sequence[str] = (),
    broadcast_key_bytes: int = BROADCAST_KEY_BYTES,
) -> LoadResult:
    """``incremental_append`` that may be run again: each load counts once, however often it is tried.

    ``target`` is a folder with a folder of rows for each load and a ledger. The rows are
    written first, then the ledger's entry; ``read_loads`` and later loads see only loads that
    have one. So a load that fails at any point leaves the table as it was; run again, it
    replaces what it has written. A load that is in the ledger is not run again: its recorded
    result is returned, and its batch is not looked at.

    Rows of a load are compared with all other loads by key, as ``incremental_append`` does; without
    a key all of them are loaded. One writer at a time, as there.
    """
    if not re.fullmatch(r"[A-Za-z0-9._-]+", load_id):
        raise ValueError(f"a load id has letters, digits, '.', '_' and '-', not {load_id!r}")
    spark = batch.sparkSession
    done = {r.load_id: LoadResult(r.loaded, r.skipped) for r in ledger(spark, target).collect()}
    if load_id in done:
        return done[load_id]
    spelled = {c.lower(): c for c in batch.columns}
    keys = [spelled[k.lower()] for k in keys]
    existing, target_rows = read_loads(spark, target), sum(r.loaded for r in done.values())
    fresh, rows = batch, None
    if existing is not None:
        batch = fresh = _aligned(batch, existing)
        # The batch takes the target's spelling.
        spelled = {c.lower(): c for c in batch.columns}
        keys = [spelled[k.lower()] for k in keys]
        if keys and target_rows:
            fresh, rows = _fresh(batch, existing, keys, target_rows, broadcast_key_bytes)
    fresh = by_key(fresh, keys) if keys else fresh
    loaded = overwrite_table(fresh, f"{target}/{_ROWS}/load_id={load_id}", keys)
    result = LoadResult(loaded, 0 if rows is None else rows - loaded)
    entry = spark.createDataFrame([(load_id, *result)], _LEDGER_SCHEMA)
    overwrite_single_file(entry, f"{target}/{_LEDGER}/{load_id}")
    return result


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """``(load_id, loaded, skipped)`` of the finished loads: one row each."""
    found = read_if_present(spark, f"{target}/{_LEDGER}/*")
    return spark.createDataFrame([], _LEDGER_SCHEMA) if found is None else found


def read_loads(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of all finished loads, None before the first one. Folders of other loads are not read."""
    done = [r.load_id for r in ledger(spark, target).collect()]
    return spark.read.parquet(*[f"{target}/{_ROWS}/load_id={i}" for i in sorted(done)]) if done else None
