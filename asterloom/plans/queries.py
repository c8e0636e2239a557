"""One query per operator, over the test tables. Each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterloom.functions import parse_date, prefixed, to_double, to_int
from asterloom.operators import (
    build_fact,
    build_fact_from_arrays,
    clean,
    date_dimension,
    entity_dimension,
    incremental_append,
    keep_one,
    left_join_children,
    load_once,
    metrics_row,
    new_rows,
    orphans,
    read_loads,
    rejects,
    require_columns,
    split_array,
    static_dimension,
    trim_columns,
)
from asterloom.plans.movies import (
    ARRAY,
    ELEMENT,
    FACT,
    GENRE_SCHEMA,
    GENRES,
    KEY,
    PAGE_ORDERS,
    PARENT_KEY,
    RECORD_SCHEMA,
    REQUIRED,
    TABLE_KEYS,
    TRIMMED,
    entity_spec,
    movie_model,
)
from asterloom.plans.pipeline import (
    Layout,
    PipelineResult,
    run_from_pages,
    run_pipeline,
    side_by_side,
)
from asterloom.plans.testdata import movie_records, single_records, table
from asterloom.sinks import (
    append_rows,
    new_scratch_dir,
    overwrite_single_file,
    overwrite_table,
    replace_safely,
    write_records,
)
from asterloom.sources import (
    concat_pages,
    flatten_pages,
    page_report,
    page_window,
    read_array_records,
    read_pages,
    read_records,
    read_replaceable,
    read_table,
    target_keys,
)

Query = Callable[[SparkSession, str], DataFrame]

IMAGE_BASE = "https://images.example.org/w500"
FACT_KEYS = TABLE_KEYS["fact_movie_metrics"]
# In the load queries, what came out before this day is in the warehouse already.
LOADED_BEFORE = "1998-01-01"
# The four orders by the name of their query, and the pages shown: first and number.
PAGE_WINDOWS = dict(zip(("release_date", "vote_average", "popularity", "title"), PAGE_ORDERS))
PAGES = (3, 5)
# A window below the rows that are cut out by a top-k.
DEEP_PAGES = (601, 5)
# A day's work: what came out in this month, against a target that holds all the rest and the
# first half of the month.
DAY_FROM, DAY_HELD, DAY_TO = "1997-03-01", "1997-03-15", "1997-04-01"
# Records in one JSON array file: those whose ids share this many numbers.
ARRAY_IDS = 4000
# Put around a text of the records, so that braces and quotes in texts are read, too.
ODD_TEXT = ('[{"}', '\\"},{')


# --- shared parts -----------------------------------------------------------------


def _clean(records: DataFrame) -> DataFrame:
    return clean(records, [KEY], REQUIRED, TRIMMED)


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean(movie_records(spark, sf_dir))


def _parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned records without the array, for what never looks at it."""
    return _clean(movie_records(spark, sf_dir, genres=False))


def _split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split_array(df, KEY, ARRAY, PARENT_KEY, ELEMENT)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact_from_arrays(_cleaned(spark, sf_dir), ARRAY, FACT)


def _stored_fact(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """The fact as a stored warehouse table, which is what a load starts from."""
    overwrite_table(_fact(spark, sf_dir), f"{folder}/fact")
    return read_table(spark, f"{folder}/fact")


def _flat(df: DataFrame) -> DataFrame:
    """Show the array as text, so that results hold scalars only."""
    items = F.transform(ARRAY, lambda g: F.coalesce(g.cast("string"), F.lit("null")))
    return df.withColumn("genres_text", F.array_join(items, ",")).drop(ARRAY)


def _exact(column: str, scale: int) -> Column:
    """Sums of decimals do not depend on the order of the rows."""
    return F.sum(F.col(column).cast(f"decimal(18,{scale})")).cast("double")


# --- cleaning ---------------------------------------------------------------------


def dedupe_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(keep_one(movie_records(spark, sf_dir), [KEY], prefer=["title"]))


def dedupe_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies that differ: one line item per order, the first by all other columns."""
    return keep_one(table(spark, sf_dir, "lineitem"), ["l_orderkey"])


def require_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_columns(movie_records(spark, sf_dir, genres=False), REQUIRED)


def trim_columns_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = movie_records(spark, sf_dir, genres=False)
    return trim_columns(records, TRIMMED).select(KEY, *TRIMMED)


def clean_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_cleaned(spark, sf_dir))


def split_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(_cleaned(spark, sf_dir))[0]


def explode_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(_cleaned(spark, sf_dir))[1]


# --- modelling --------------------------------------------------------------------


def dim_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every static category with the number of bridge rows that use it."""
    used = explode_bridge(spark, sf_dir).groupBy(ELEMENT).agg(F.count(F.lit(1)).alias("n"))
    genres = static_dimension(spark, GENRES, GENRE_SCHEMA)
    return genres.join(used, ELEMENT, "left").select(
        ELEMENT, "genre_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("bridge_rows")
    )


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_dimension(_parents(spark, sf_dir), "release_date")


def dim_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_dimension(_parents(spark, sf_dir), entity_spec(IMAGE_BASE))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact by joining the parent and the bridge, as two stored tables would be."""
    cleaned = _cleaned(spark, sf_dir)
    folder = new_scratch_dir(spark, "fact")
    overwrite_table(cleaned, f"{folder}/records")
    parent, bridge = _split(read_table(spark, f"{folder}/records"))
    return build_fact(parent, bridge, FACT)


def fact_from_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir)


def left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their line items; orders without one give a row of nulls."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return left_join_children(orders, lines, "o_orderkey", "l_orderkey")


def casts(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = movie_records(spark, sf_dir, genres=False)
    date = parse_date(F.col("release_date"))
    return records.select(
        KEY,
        date.alias("date_id"),
        F.year(date).cast("string").alias("year"),
        F.month(date).cast("string").alias("month"),
        F.dayofmonth(date).cast("string").alias("day"),
        prefixed(IMAGE_BASE, F.col("poster_path")).alias("poster_url"),
        to_double(F.col("popularity")).alias("popularity"),
        to_int(F.col("vote_count")).alias("vote_count"),
    )


def orphan_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    genres = static_dimension(spark, GENRES, GENRE_SCHEMA)
    return orphans(_fact(spark, sf_dir), genres, ELEMENT)


# --- pages ------------------------------------------------------------------------


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What can be paged: the cleaned movies, dates as dates."""
    return _parents(spark, sf_dir).select(
        KEY,
        "title",
        "original_title",
        parse_date(F.col("release_date")).alias("primary_release_date"),
        "popularity",
        "vote_average",
    )


def window_of(order: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_window(_catalogue(spark, sf_dir), order, KEY, *PAGES)


def page_window_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows below the first 12,000."""
    return page_window(_catalogue(spark, sf_dir), "popularity.desc", KEY, *DEEP_PAGES)


def page_window_wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A window that passes the last page and goes on at the first one."""
    return page_window(_catalogue(spark, sf_dir), "popularity.desc", KEY, 9, 4, last_page=10)


def union_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two windows that overlap by one page: its rows come twice."""
    catalogue = _catalogue(spark, sf_dir)
    first = page_window(catalogue, "popularity.desc", KEY, 1, 3)
    return concat_pages(first, page_window(catalogue, "popularity.desc", KEY, 3, 2))


def _landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page per order, written as text: most with one result, some with two or without
    any, and some cut off in the middle. Of the readable ones some have a field of the wrong
    type, some a field that comes twice, some both."""
    records = single_records(spark, sf_dir)
    record = F.struct(*RECORD_SCHEMA.names)
    results = F.when(
        F.col(KEY) % 50 != 0,
        F.when(F.col(KEY) % 20 == 0, F.array(record, record)).otherwise(F.array(record)),
    )
    text = F.to_json(F.struct(F.col(KEY).alias("page"), results.alias("results")))
    cut = F.substring(text, F.lit(1), F.length(text) - 3)
    both = F.col(KEY) % 71 == 0
    mistyped = F.regexp_replace(text, '"vote_count":[0-9]+', '"vote_count":"many"')
    text = F.when(both | (F.col(KEY) % 89 == 0), mistyped).otherwise(text)
    again = F.concat(F.expr("substring(text, 1, length(text) - 1)"), F.lit(',"page":'), KEY, F.lit("}"))
    twice = F.when(both | (F.col(KEY) % 83 == 0), again).otherwise(F.col("text"))
    lines = records.select(KEY, text.alias("text"), cut.alias("cut"))
    lines = lines.select(F.when(F.col(KEY) % 97 == 0, F.col("cut")).otherwise(twice).alias("value"))
    folder = new_scratch_dir(spark, "pages")
    lines.write.text(folder)
    return read_pages(spark, folder, RECORD_SCHEMA, multiline=False)


def flatten_pages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(flatten_pages(_landed_pages(spark, sf_dir)))


def page_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_report(_landed_pages(spark, sf_dir))


# --- loading ----------------------------------------------------------------------


def _history(batch: DataFrame) -> DataFrame:
    return batch.filter(F.col("date_id") < F.lit(LOADED_BEFORE).cast("date"))


def new_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch_dir(spark, "new-rows")
    batch = _stored_fact(spark, sf_dir, folder)
    overwrite_table(_history(batch), f"{folder}/target")
    return new_rows(batch, target_keys(spark, f"{folder}/target", FACT_KEYS), FACT_KEYS)


def _day(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of a month, categories of null included, and those of all other days and of
    its first half."""
    date = F.col("date_id")
    month = (date >= F.lit(DAY_FROM).cast("date")) & (date < F.lit(DAY_TO).cast("date"))
    held = ~F.coalesce(month, F.lit(False)) | (date < F.lit(DAY_HELD).cast("date"))
    return batch.filter(month), batch.filter(held)


def new_rows_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month's batch, small beside its target: nothing of the target is shuffled."""
    folder = new_scratch_dir(spark, "new-rows")
    month, held = _day(_stored_fact(spark, sf_dir, folder))
    overwrite_table(held, f"{folder}/target")
    keys = target_keys(spark, f"{folder}/target", FACT_KEYS)
    return new_rows(month, keys, FACT_KEYS, small=True)


def _append_day(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    folder = new_scratch_dir(spark, "append")
    month, held = _day(_stored_fact(spark, sf_dir, folder))
    append_rows(held.withColumn("popularity", F.col("popularity") / 2), f"{folder}/target")
    incremental_append(month, f"{folder}/target", FACT_KEYS, **options)
    return read_table(spark, f"{folder}/target")


def append_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month's batch, broadcast to a target many times as large; stored rows stay."""
    return _append_day(spark, sf_dir)


def append_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's rows, with ids from the whole range, for a target of two loads that span it, too.

    The better films of the day are new to the target; what it holds is at half its popularity.
    """
    folder = new_scratch_dir(spark, "append")
    fact = _stored_fact(spark, sf_dir, folder)
    day = F.coalesce(F.col("date_id") == F.lit(DAY_FROM).cast("date"), F.lit(False))
    held = fact.filter(~day | (F.col("vote_average") < 5))
    held = held.withColumn("popularity", F.col("popularity") / 2)
    for part in (_history(held), held):
        incremental_append(part, f"{folder}/target", FACT_KEYS)
    incremental_append(fact.filter(day), f"{folder}/target", FACT_KEYS)
    return read_table(spark, f"{folder}/target")


def target_keys_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch_dir(spark, "target-keys")
    append_rows(_fact(spark, sf_dir), f"{folder}/target")
    return target_keys(spark, f"{folder}/target", FACT_KEYS)


def append_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target does not exist yet."""
    folder = new_scratch_dir(spark, "append")
    incremental_append(_stored_fact(spark, sf_dir, folder), f"{folder}/target", FACT_KEYS)
    return read_table(spark, f"{folder}/target")


def append_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target holds the history, at half its popularity: stored rows stay as they are."""
    folder = new_scratch_dir(spark, "append")
    batch = _stored_fact(spark, sf_dir, folder)
    old = _history(batch).withColumn("popularity", F.col("popularity") / 2)
    append_rows(old, f"{folder}/target")
    incremental_append(batch, f"{folder}/target", FACT_KEYS)
    return read_table(spark, f"{folder}/target")


def append_second_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month's batch again, taken as too large for a broadcast."""
    return _append_day(spark, sf_dir, broadcast_key_bytes=-1)


def append_none_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch comes twice; the second time nothing is new."""
    folder = new_scratch_dir(spark, "append")
    batch = _stored_fact(spark, sf_dir, folder)
    incremental_append(batch, f"{folder}/target", FACT_KEYS)
    incremental_append(batch, f"{folder}/target", FACT_KEYS)
    return read_table(spark, f"{folder}/target")


def append_keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No key registered: the second batch is appended as a whole."""
    folder = new_scratch_dir(spark, "append")
    batch = _stored_fact(spark, sf_dir, folder)
    incremental_append(batch, f"{folder}/target")
    incremental_append(batch, f"{folder}/target")
    return read_table(spark, f"{folder}/target")


def append_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(loaded, skipped) of the five cases."""
    folder = new_scratch_dir(spark, "append")
    batch = _stored_fact(spark, sf_dir, folder)
    overwrite_table(batch.filter(F.lit(False)), f"{folder}/empty")
    overwrite_table(_history(batch), f"{folder}/history")
    results = {
        "missing": incremental_append(batch, f"{folder}/missing", FACT_KEYS),
        "none_new": incremental_append(batch, f"{folder}/missing", FACT_KEYS),
        "empty": incremental_append(batch, f"{folder}/empty", FACT_KEYS),
        "some_new": incremental_append(batch, f"{folder}/history", FACT_KEYS),
        "no_key": incremental_append(batch, f"{folder}/history"),
    }
    return spark.createDataFrame(
        [(case, *result) for case, result in results.items()],
        "target_case string, loaded bigint, skipped bigint",
    )


def load_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads, the first without a key, each tried twice: every row is there once."""
    folder = new_scratch_dir(spark, "loads")
    batch = _stored_fact(spark, sf_dir, folder)
    old = _history(batch).withColumn("popularity", F.col("popularity") / 2)
    for _ in range(2):
        load_once(old, f"{folder}/target", "history")
    for _ in range(2):
        load_once(batch, f"{folder}/target", "all", FACT_KEYS)
    return read_loads(spark, f"{folder}/target")


# --- quality, round trips, whole runs -----------------------------------------------


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = movie_records(spark, sf_dir)
    one, found = F.count(F.lit(1)), F.size(F.array_compact(ARRAY))
    return metrics_row(
        (raw, {"raw_rows": one}),
        (
            _clean(raw),
            {
                "clean_rows": one,
                "bridge_rows": F.sum(F.when(F.col(ARRAY).isNull(), 0).otherwise(found)),
            },
        ),
    ).withColumn("removed_rows", F.col("raw_rows") - F.col("clean_rows"))


def rejected_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What cleaning removes, by id and reason."""
    return rejects(movie_records(spark, sf_dir, genres=False), [KEY], REQUIRED)


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch_dir(spark, "json")
    write_records(movie_records(spark, sf_dir), folder)
    return _flat(read_records(spark, folder, RECORD_SCHEMA, multiline=False))


def _landed_arrays(spark: SparkSession, records: DataFrame) -> str:
    """Files that each hold one JSON array over several lines: at most two records for each of
    ``ARRAY_IDS`` neighbouring ids, so the number of files follows that of the records."""
    folder = new_scratch_dir(spark, "json-arrays")
    line = F.to_json(F.struct(*RECORD_SCHEMA.names)).alias("line")
    group = F.floor(F.col(KEY) / ARRAY_IDS).alias("file")
    lines = records.select(group, line).groupBy("file")
    joined = F.array_join(F.collect_list("line"), ",\n")
    arrays = lines.agg(F.concat(F.lit("[\n"), joined, F.lit("\n]")).alias("value")).select("value")
    arrays.write.option("maxRecordsPerFile", 1).text(folder)
    return folder


def json_array_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON array files, each read whole by one task."""
    folder = _landed_arrays(spark, movie_records(spark, sf_dir))
    return _flat(read_records(spark, folder, RECORD_SCHEMA, multiline=True))


def json_array_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON array files, each read in as many ranges as Spark splits it into."""
    before, after = map(F.lit, ODD_TEXT)
    records = movie_records(spark, sf_dir).withColumn("overview", F.concat(before, "overview", after))
    return _flat(read_array_records(spark, _landed_arrays(spark, records), RECORD_SCHEMA))


def parquet_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice to the same place: the second write replaces the first."""
    folder = new_scratch_dir(spark, "parquet")
    records = movie_records(spark, sf_dir)
    overwrite_table(records, folder)
    overwrite_table(records, folder)
    return _flat(read_table(spark, folder))


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced twice, the second time by rows that are read from it."""
    folder = new_scratch_dir(spark, "replaced")
    replace_safely(_fact(spark, sf_dir), folder)
    replace_safely(_history(read_replaceable(spark, folder)), folder)
    return read_replaceable(spark, folder)


def single_file_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch_dir(spark, "single")
    overwrite_single_file(dim_date(spark, sf_dir), folder)
    return read_table(spark, folder)


def _pipeline(
    spark: SparkSession, sf_dir: str, layout: Layout, flat: bool = False
) -> PipelineResult:
    return run_pipeline(movie_records(spark, sf_dir), layout, movie_model(IMAGE_BASE, flat))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded fact of a whole run."""
    layout = Layout.under(new_scratch_dir(spark, "pipeline"))
    _pipeline(spark, sf_dir, layout)
    return read_table(spark, f"{layout.target}/fact_movie_metrics")


def pipeline_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loaded fact of a run that stores a parent and a bridge table and joins them."""
    layout = Layout.under(new_scratch_dir(spark, "pipeline"))
    _pipeline(spark, sf_dir, layout, flat=True)
    return read_table(spark, f"{layout.target}/fact_movie_metrics")


def pipeline_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All row counts of a run from pages: pages read and broken, and orphans among them."""
    layout = Layout.under(new_scratch_dir(spark, "pipeline"))
    pages = _landed_pages(spark, sf_dir)
    result = run_from_pages(pages, layout, movie_model(IMAGE_BASE), load=False)
    return spark.createDataFrame(list(result.counts.items()), "name string, n_rows bigint")


def pipeline_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded and skipped per table, in two runs over the same stored records."""
    folder = new_scratch_dir(spark, "pipeline")
    overwrite_table(movie_records(spark, sf_dir), f"{folder}/records")
    records = read_table(spark, f"{folder}/records")
    layout, model = Layout.under(folder), movie_model(IMAGE_BASE)
    rows = [
        (run, name, *result)
        for run in (1, 2)
        for name, result in run_pipeline(records, layout, model).loads.items()
    ]
    return spark.createDataFrame(
        rows, "run int, table_name string, loaded bigint, skipped bigint"
    )


# --- what the star schema is read for -------------------------------------------------


def _star(spark: SparkSession, sf_dir: str, *roles: str) -> dict[str, DataFrame]:
    """Tables of the star schema, stored once and read back: what a consumer starts from.

    The cleaned records are stored, too, so that they are cleaned once for all tables.
    """
    folder = new_scratch_dir(spark, "star")
    source = _cleaned(spark, sf_dir) if "fact" in roles else _parents(spark, sf_dir)
    overwrite_table(source, f"{folder}/records")
    stored = read_table(spark, f"{folder}/records")
    tables = {
        "fact": lambda: build_fact_from_arrays(stored, ARRAY, FACT),
        "date": lambda: date_dimension(stored, "release_date"),
        "entity": lambda: entity_dimension(stored, entity_spec(IMAGE_BASE)),
    }
    side_by_side(
        spark, {r: partial(overwrite_table, tables[r](), f"{folder}/{r}") for r in roles}
    )
    return {r: read_table(spark, f"{folder}/{r}") for r in roles}


def _per_movie(fact_rows: DataFrame) -> DataFrame:
    """One row per movie: the fact repeats a movie's metrics for each of its categories."""
    metrics = ("date_id", "popularity", "vote_average", "vote_count")
    return fact_rows.groupBy(PARENT_KEY).agg(*[F.max(c).alias(c) for c in metrics])


def metrics_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact by category; categories without a name keep their id."""
    sums = _star(spark, sf_dir, "fact")["fact"].groupBy(ELEMENT).agg(
        F.count(F.lit(1)).alias("fact_rows"),
        _exact("popularity", 2).alias("popularity"),
        F.sum("vote_count").alias("vote_count"),
        (_exact("vote_average", 1) / F.count("vote_average")).alias("vote_average"),
    )
    return sums.join(static_dimension(spark, GENRES, GENRE_SCHEMA), ELEMENT, "left")


def metrics_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movies by year and month of the date dimension, each movie counted once."""
    star = _star(spark, sf_dir, "fact", "date")
    per_date = _per_movie(star["fact"]).groupBy("date_id").agg(
        F.count(F.lit(1)).alias("movies"),
        F.sum(F.col("popularity").cast("decimal(18,2)")).alias("popularity"),
    )
    joined = per_date.join(star["date"], "date_id", "left").groupBy("year", "month")
    return joined.agg(
        F.sum("movies").alias("movies"), F.sum("popularity").cast("double").alias("popularity")
    )


def top_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 most popular movies. Only those 20 rows meet the movie dimension."""
    star = _star(spark, sf_dir, "fact", "entity")
    top = (
        _per_movie(star["fact"])
        .select(PARENT_KEY, "popularity", "vote_count")
        .orderBy(F.desc_nulls_last("popularity"), PARENT_KEY)
        .limit(20)
    )
    titles = star["entity"].select(PARENT_KEY, "title")
    return titles.join(F.broadcast(top), PARENT_KEY)


def entity_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over movies, not over fact rows."""
    return _per_movie(_star(spark, sf_dir, "fact")["fact"]).agg(
        F.count(F.lit(1)).alias("movies"),
        _exact("popularity", 2).alias("popularity"),
        F.sum("vote_count").alias("vote_count"),
    )


QUERIES: dict[str, Query] = {
    "dedupe_key": dedupe_key,
    "dedupe_lines": dedupe_lines,
    "require_columns": require_columns_query,
    "trim_columns": trim_columns_query,
    "clean": clean_query,
    "split_parent": split_parent,
    "explode_bridge": explode_bridge,
    "dim_static": dim_static,
    "dim_date": dim_date,
    "dim_entity": dim_entity,
    "fact": fact,
    "fact_from_arrays": fact_from_arrays,
    "left_join": left_join,
    "casts": casts,
    "orphan_categories": orphan_categories,
    **{f"page_window_{name}": partial(window_of, order) for name, order in PAGE_WINDOWS.items()},
    "page_window_deep": page_window_deep,
    "page_window_wrapped": page_window_wrapped,
    "union_pages": union_pages,
    "flatten_pages": flatten_pages_query,
    "page_report": page_report_query,
    "new_rows": new_rows_query,
    "new_rows_small": new_rows_small,
    "target_keys": target_keys_query,
    "append_first": append_first,
    "append_second": append_second,
    "append_day": append_day,
    "append_spread": append_spread,
    "append_second_shuffled": append_second_shuffled,
    "append_none_new": append_none_new,
    "append_keyless": append_keyless,
    "append_counts": append_counts,
    "load_retried": load_retried,
    "quality_counts": quality_counts,
    "rejected_records": rejected_records,
    "json_array_scan": json_array_scan,
    "json_array_ranges": json_array_ranges,
    "json_round_trip": json_round_trip,
    "parquet_round_trip": parquet_round_trip,
    "replaced_table": replaced_table,
    "single_file_round_trip": single_file_round_trip,
    "star_pipeline": pipeline,
    "star_pipeline_flat": pipeline_flat,
    "pipeline_report": pipeline_report,
    "pipeline_counts": pipeline_counts,
    "metrics_by_category": metrics_by_category,
    "metrics_by_month": metrics_by_month,
    "top_entities": top_entities,
    "entity_totals": entity_totals,
}
