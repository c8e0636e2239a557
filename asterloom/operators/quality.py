"""Row counts, data-quality metrics and the non-empty guard."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asterloom.functions import named
from asterloom.sources import concat_pages


def row_count(df: DataFrame) -> int:
    """Count rows as an own job. The writers count while they write, which is cheaper."""
    return df.count()


def metrics_row(*parts: tuple[DataFrame, Mapping[str, Column]]) -> DataFrame:
    """One row of metrics from several frames, each aggregated once.

    ``parts`` are (frame, {metric: aggregate}). Each frame is reduced to a single row
    before those rows are brought together.
    """
    names = [name for _, metrics in parts for name in metrics]
    rows = [
        df.agg(*[m.cast("bigint").alias(n) for n, m in metrics.items()]).select(
            *[
                named(n) if n in metrics else F.lit(None).cast("bigint").alias(n)
                for n in names
            ]
        )
        for df, metrics in parts
    ]
    return concat_pages(*rows).agg(
        *[F.coalesce(F.sum(named(n)), F.lit(0)).cast("bigint").alias(n) for n in names]
    )


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Non-null fact keys without a dimension row, with the number of fact rows of each.

    The fact is counted per key first, so the join sees distinct keys only.
    """
    used = fact.filter(named(key).isNotNull()).groupBy(named(key))
    counts = used.agg(F.count(F.lit(1)).alias("fact_rows"))
    return counts.join(dimension.select(named(key)), key, "left_anti")


def require_non_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail if there is not a single row; reads no further than the first one."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
