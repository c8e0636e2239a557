"""Star schema: static, calendar and entity dimensions, and the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.functions import calendar_parts, named, parse_date, prefixed, to_double, to_int
from asterloom.sources import concat_pages, literal_table


@dataclass(frozen=True)
class EntitySpec:
    """Layout of an entity dimension.

    ``columns`` is the output in order. A column is copied from the source column of
    the same name unless ``renamed`` names another source, ``prefixes`` gives it as
    (constant, path column), or ``dates`` says its text is to be parsed.
    """

    columns: Sequence[str]
    renamed: Mapping[str, str] = field(default_factory=dict)
    prefixes: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    dates: Sequence[str] = ()


@dataclass(frozen=True)
class FactSpec:
    """Layout of a fact table at (entity, category) grain.

    Output: ``bridge_key``, ``category``, ``date_as``, then ``doubles`` and ``ints``.
    """

    parent_key: str
    bridge_key: str
    category: str
    date: str
    date_as: str
    doubles: Sequence[str] = ()
    ints: Sequence[str] = ()
    overflow: str = "raise"


def static_dimension(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A dimension whose rows are fixed and few."""
    return literal_table(spark, rows, schema)


def date_dimension(df: DataFrame, column: str, date_as: str = "date_id") -> DataFrame:
    """The distinct valid dates of a text column, with year, month and day as text.

    The parts follow from the date, so only the date is compared and shuffled, and
    each task first reduces its rows to the dates it has seen.
    """
    dates = df.select(parse_date(named(column)).alias(date_as))
    dates = dates.filter(named(date_as).isNotNull()).distinct()
    return dates.withColumns(calendar_parts(named(date_as)))


def entity_dimension(df: DataFrame, spec: EntitySpec) -> DataFrame:
    """Project a cleaned parent table to an entity dimension; no shuffle."""

    def build(column: str) -> Column:
        if column in spec.prefixes:
            prefix, path = spec.prefixes[column]
            return prefixed(prefix, named(path))
        source = named(spec.renamed.get(column, column))
        return parse_date(source) if column in spec.dates else source

    return df.select(*[build(c).alias(c) for c in spec.columns])


def left_join_children(
    parent: DataFrame, child: DataFrame, parent_key: str, child_key: str
) -> DataFrame:
    """``parent LEFT JOIN child``: 1:N, parents without a child give one row of nulls.

    The two frames share no column name. ``child`` may hold any share of its rows under
    one key. A left join can split a hot partition of its left side only, which does not
    help here. So matches come from an inner join, of which adaptive execution splits
    either side, and the other parents from an anti join against the distinct child
    keys, which are reduced before their shuffle. Both joins read the same shuffle of
    the parents. Parents with a null key match nothing and are not shuffled at all.
    """
    keyed = parent.filter(named(parent_key).isNotNull())
    child = child.filter(named(child_key).isNotNull())
    p_key, c_key = named(parent_key, "p"), named(child_key, "c")

    matched = keyed.alias("p").join(child.alias("c"), p_key == c_key, "inner")
    keys = child.select(named(child_key)).distinct()
    childless = keyed.alias("p").join(keys.alias("c"), p_key == c_key, "left_anti")
    keyless = parent.filter(named(parent_key).isNull())

    columns = [named(c, "p") for c in parent.columns]
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in child.schema]
    return concat_pages(
        matched.select(*columns, *[named(c, "c") for c in child.columns]),
        childless.select(*columns, *nulls),
        keyless.select("*", *nulls),
    )


def _measures(spec: FactSpec) -> dict[str, Column]:
    return {
        spec.date_as: parse_date(named(spec.date)),
        **{c: to_double(named(c)) for c in spec.doubles},
        **{c: to_int(named(c), spec.overflow) for c in spec.ints},
    }


def build_fact(parent: DataFrame, bridge: DataFrame, spec: FactSpec) -> DataFrame:
    """Fact at (entity, category) grain from the parent and bridge tables.

    Parents without a category keep one row with a null category; categories unknown to
    the dimension stay.
    """
    # The parents are reduced to their final, narrow columns before they are shuffled.
    # New names keep the projection the same in every branch of the join, which lets
    # the branches share that shuffle.
    inner = "__asterloom_{}".format
    measures = _measures(spec)
    parents = parent.select(
        named(spec.parent_key).alias(inner(spec.bridge_key)),
        *[column.alias(inner(name)) for name, column in measures.items()],
    )
    children = bridge.select(named(spec.bridge_key), named(spec.category))
    joined = left_join_children(parents, children, inner(spec.bridge_key), spec.bridge_key)
    return joined.select(
        named(inner(spec.bridge_key)).alias(spec.bridge_key),
        named(spec.category),
        *[named(inner(name)).alias(name) for name in measures],
    )


def build_fact_from_arrays(df: DataFrame, array: str, spec: FactSpec) -> DataFrame:
    """The same fact from cleaned nested records, without a join or a shuffle.

    With one record per key, the left join of parent and bridge is the record's own
    array opened up, null elements dropped, and one null row where nothing is left.
    """
    return df.select(
        named(spec.parent_key).alias(spec.bridge_key),
        F.explode_outer(F.array_compact(named(array))).alias(spec.category),
        *[column.alias(name) for name, column in _measures(spec).items()],
    )
