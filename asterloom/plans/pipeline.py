"""The layers of a run: land, clean and split, model, load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.functions import named

from asterloom.operators import (
    EntitySpec,
    FactSpec,
    LoadResult,
    build_fact,
    build_fact_from_arrays,
    clean,
    date_dimension,
    entity_dimension,
    incremental_append,
    require_non_empty,
    split_array,
    static_dimension,
)
from asterloom.sinks import (
    overwrite_single_file,
    overwrite_table,
    write_observed,
    write_records,
    write_table,
)
from asterloom.sources import (
    flatten_pages,
    page_metrics,
    read_records,
    read_table,
)


@dataclass(frozen=True)
class StarModel:
    """All a pipeline run has to know about one kind of record.

    ``flat`` says how the processed layer is stored: cleaned records with their array,
    from which the fact is built without a join, or a parent and a bridge table, which
    are joined. Either way the cleaned data is written once for what the star needs.
    """

    record_schema: T.StructType
    key: str
    required: Sequence[str]
    trimmed: Sequence[str]
    array: str
    parent_key: str
    element: str
    static_rows: Sequence[tuple]
    static_schema: str
    date: str
    entity: EntitySpec
    fact: FactSpec
    table_keys: Mapping[str, Sequence[str]]
    tables: Mapping[str, str]
    flat: bool = False


@dataclass(frozen=True)
class Layout:
    """Folders of the three layers and of the accumulating target, all on shared storage."""

    raw: str
    processed: str
    warehouse: str
    target: str

    @classmethod
    def under(cls, root: str) -> Layout:
        root = root.rstrip("/")
        return cls(*(f"{root}/{layer}" for layer in ("raw", "processed", "warehouse", "target")))


@dataclass(frozen=True)
class PipelineResult:
    """Row counts of every stage, and (loaded, skipped) per target table.

    Among the counts are ``orphans``, fact rows with a category that the static
    dimension does not have, and ``pages`` and ``broken_pages`` of a run from pages.
    """

    counts: dict[str, int]
    loads: dict[str, LoadResult] = field(default_factory=dict)


def side_by_side(spark: SparkSession, jobs: dict) -> dict:
    """Submit independent Spark jobs at once, so that small ones do not wait in line."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        # The threads work under the caller's job group, tags and scheduler pool.
        futures = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in jobs.items()
        }
        return {name: future.result() for name, future in futures.items()}


def land_layer(records: DataFrame, layout: Layout) -> dict[str, int]:
    """Replace the raw layer by ``records``; fail if there are none."""
    return {"raw": write_records(require_non_empty(records, "records"), layout.raw)}


def land_pages(pages: DataFrame, layout: Layout) -> dict[str, int]:
    """Replace the raw layer by the records of page envelopes; fail if there are none.

    Pages that cannot be read are skipped; they are counted in the same pass.
    """
    metrics = page_metrics()
    seen = Observation()
    observed = pages.observe(seen, *[m.alias(name) for name, m in metrics.items()])
    require_non_empty(flatten_pages(pages), "pages")
    raw = write_records(flatten_pages(observed), layout.raw)
    return {name: seen.get[name] for name in ("pages", "broken_pages")} | {"raw": raw}


def _processed(layout: Layout, table: str) -> str:
    return f"{layout.processed}/{table}"


def clean_layer(spark: SparkSession, layout: Layout, model: StarModel) -> dict[str, int]:
    """Replace the processed layer by the cleaned raw layer.

    The cleaned records are written once, nested, as ``records_clean``; that table cuts
    the lineage. A flat model also gets its parent and bridge table, one pass each over
    what they need of it. ``parent_and_bridge`` gives both as views for other readers.
    """
    raw = read_records(spark, layout.raw, model.record_schema, multiline=False)
    cleaned = clean(raw, [model.key], model.required, model.trimmed)
    counts = {"clean": overwrite_table(cleaned, _processed(layout, "records_clean"))}
    if model.flat:
        parent, bridge = parent_and_bridge(spark, layout, model)
        tables = {model.tables["parent"]: parent, model.tables["bridge"]: bridge}
        counts |= side_by_side(
            spark,
            {
                name: partial(overwrite_table, df, _processed(layout, name))
                for name, df in tables.items()
            },
        )
    return counts


def parent_and_bridge(
    spark: SparkSession, layout: Layout, model: StarModel
) -> tuple[DataFrame, DataFrame]:
    """The cleaned records as a parent and a bridge table, derived from the nested ones."""
    staged = read_table(spark, _processed(layout, "records_clean"))
    return split_array(staged, model.key, model.array, model.parent_key, model.element)


def star_layer(spark: SparkSession, layout: Layout, model: StarModel) -> dict[str, int]:
    """Replace the warehouse layer; one pass over the processed layer per table.

    The static and the calendar dimension are small by nature and get one file each.
    The entity dimension and the fact grow with the records and are written in parallel;
    the fact's orphans are counted while it is written, against the static rows.
    """
    if model.flat:
        staged = read_table(spark, _processed(layout, model.tables["parent"]))
        bridge = read_table(spark, _processed(layout, model.tables["bridge"]))
        fact = build_fact(staged, bridge, model.fact)
    else:
        staged = read_table(spark, _processed(layout, "records_clean"))
        fact = build_fact_from_arrays(staged, model.array, model.fact)
    tables = {
        "static": static_dimension(spark, model.static_rows, model.static_schema),
        "date": date_dimension(staged, model.date),
        "entity": entity_dimension(staged, model.entity),
    }

    def path(role: str) -> str:
        return f"{layout.warehouse}/{model.tables[role]}"

    category = named(model.element)
    known = [row[0] for row in model.static_rows]
    orphans = {"orphans": F.count_if(category.isNotNull() & ~category.isin(known))}
    jobs = {
        model.tables[role]: partial(
            overwrite_table if role == "entity" else overwrite_single_file, df, path(role)
        )
        for role, df in tables.items()
    }
    jobs["fact"] = partial(
        write_observed, fact, lambda d: write_table(d, path("fact")), orphans
    )
    counts = side_by_side(spark, jobs)
    written = counts.pop("fact")
    return counts | {model.tables["fact"]: written["rows"], "orphans": written["orphans"]}


def load_layer(
    spark: SparkSession, layout: Layout, model: StarModel, tables: Sequence[str] | None = None
) -> dict[str, LoadResult]:
    """Append what is new in the warehouse tables (all, or those named) to the target."""
    return side_by_side(
        spark,
        {
            table: partial(
                incremental_append,
                read_table(spark, f"{layout.warehouse}/{table}"),
                f"{layout.target}/{table}",
                model.table_keys.get(table, ()),
            )
            for table in tables or model.table_keys
        },
    )


def run_pipeline(
    records: DataFrame, layout: Layout, model: StarModel, load: bool = True
) -> PipelineResult:
    """Run every layer on ``records`` (raw, nested), the load only if wanted."""
    return _run(records.sparkSession, land_layer(records, layout), layout, model, load)


def run_from_pages(
    pages: DataFrame, layout: Layout, model: StarModel, load: bool = True
) -> PipelineResult:
    """Run every layer on page envelopes, as ``read_pages`` gives them."""
    return _run(pages.sparkSession, land_pages(pages, layout), layout, model, load)


def _run(
    spark: SparkSession, landed: dict[str, int], layout: Layout, model: StarModel, load: bool
) -> PipelineResult:
    counts = landed | clean_layer(spark, layout, model)
    counts["removed"] = counts["raw"] - counts["clean"]
    counts |= star_layer(spark, layout, model)
    return PipelineResult(counts, load_layer(spark, layout, model) if load else {})
