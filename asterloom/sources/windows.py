"""Sorted page windows over a catalogue table, and their concatenation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterloom.functions import named
from asterloom.scratch import new_scratch_dir

# Down to this row a window is a top-k, in which every task sends on all rows above the
# window's end. Deeper windows are cut out of ranges of the order.
TOP_ROWS = 10_000
_RANGE = "__asterloom_range"


def page_window(
    df: DataFrame,
    sort: str,
    key: str,
    start_page: int,
    pages: int,
    page_size: int = 20,
    last_page: int | None = None,
    top_rows: int = TOP_ROWS,
) -> DataFrame:
    """Pages ``start_page .. start_page + pages - 1`` of ``df`` under one order.

    ``sort`` is ``<column>.asc`` or ``<column>.desc``. Nulls come last and ties are
    broken by ``key``, so a page always holds the same rows. Pages past the end of the
    table are empty. With ``last_page``, as paged services have one, later pages are
    refused and a window that passes it goes on at page 1.

    A window that ends within ``top_rows`` rows is a top-k (``TakeOrderedAndProject``).
    For a deeper one the table, projected by the caller to the columns wanted, is
    written in ranges of the order; their row counts tell which of them the window
    touches, and only these are sorted. Both ways give the same rows.
    """
    column, _, direction = sort.rpartition(".")
    if not column or direction not in ("asc", "desc"):
        raise ValueError(f"sort must be '<column>.asc' or '<column>.desc', not {sort!r}")
    if start_page < 1 or pages < 1 or page_size < 1:
        raise ValueError("pages are counted from 1")
    if last_page is not None and (start_page > last_page or pages > last_page):
        raise ValueError(f"window outside pages 1..{last_page}")

    value = named(column)
    order = [
        value.asc_nulls_last() if direction == "asc" else value.desc_nulls_last(),
        named(key).asc_nulls_last(),
    ]

    def span(first: int, last: int) -> DataFrame:
        skip, take = (first - 1) * page_size, (last - first + 1) * page_size
        if skip + take > top_rows:
            return _deep_rows(df, order, skip, take)
        return df.orderBy(*order).offset(skip).limit(take)

    end = start_page + pages - 1
    if last_page is None or end <= last_page:
        return span(start_page, end)
    return concat_pages(span(start_page, last_page), span(1, end - last_page))


def _deep_rows(df: DataFrame, order: list[Column], skip: int, take: int) -> DataFrame:
    """Rows ``skip + 1 .. skip + take`` of the order, of which only some ranges are sorted."""
    folder = new_scratch_dir(df.sparkSession, "ranges")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = df.repartitionByRange(n, *order).withColumn(_RANGE, F.spark_partition_id())
    ranges.write.parquet(folder)
    stored = df.sparkSession.read.schema(ranges.schema).parquet(folder)
    touched, before, skipped = [], 0, 0
    # One row per range.
    for number, rows in sorted(stored.groupBy(_RANGE).count().collect()):
        if before + rows <= skip:
            skipped = before + rows
        elif before < skip + take:
            touched.append(number)
        before += rows
    part = stored.filter(F.col(_RANGE).isin(touched)).drop(_RANGE)
    return part.orderBy(*order).offset(skip - skipped).limit(take)


def concat_pages(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; duplicates stay."""
    return reduce(DataFrame.unionByName, frames)
