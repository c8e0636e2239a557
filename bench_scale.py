"""Time the operators next to their plain Spark forms on many copies of the test records.

BENCH_SF_DIR (default sf0.1), BENCH_COPIES (100) and BENCH_CPUS set the size; with BENCH_HOT=1
a third of the records share one id and a third of the bridge rows one movie. Everything goes
to a new folder below ``spark.checkpoint.dir`` (or a temporary one). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asterloom.functions import parse_date
from asterloom.operators import (
    build_fact,
    build_fact_from_arrays,
    clean,
    incremental_append,
    load,
    new_rows,
    split_array,
)
from asterloom.plans import movies as m
from asterloom.plans.testdata import movie_records
from asterloom.sinks import append_rows, new_scratch_dir, overwrite_table

FACT_KEYS = m.TABLE_KEYS["fact_movie_metrics"]
# Loads of the target that a batch of few keys is compared with.
LOADS = 6


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    copies = int(os.environ.get("BENCH_COPIES", "100"))
    hot = os.environ.get("BENCH_HOT") == "1"
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', os.cpu_count())}]")
        .appName("bench-scale")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.parquet.pushdown.inFilterThreshold", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = new_scratch_dir(spark, "bench-scale")
    seconds: dict[str, float] = {}

    def timed(name: str, job):
        start = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - start, 1)
        return result

    def stored(name: str, df: DataFrame) -> DataFrame:
        overwrite_table(df, f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    def run(df: DataFrame) -> None:
        df.write.format("noop").mode("overwrite").save()

    one = stored("one", movie_records(spark, sf_dir).repartition(16))
    span = one.agg(F.max("id")).first()[0] + 1
    many = one.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    many = many.withColumn("id", F.col("id") + F.col("copy") * span).drop("copy")
    if hot:
        many = many.withColumn("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")))
    raw = stored("raw", many)

    timed("one_per_key_plain", lambda: run(
        raw.dropDuplicates([m.KEY]).filter("id IS NOT NULL AND title IS NOT NULL")))
    cleaned = clean(raw, [m.KEY], m.REQUIRED, m.TRIMMED)
    timed("one_per_key", lambda: run(cleaned))

    cleaned = stored("cleaned", cleaned)
    parent, bridge = split_array(cleaned, m.KEY, m.ARRAY, m.PARENT_KEY, m.ELEMENT)
    if hot:
        hot_key = F.when(F.hash("movie_id", "genre_id") % 3 == 0, 11).otherwise(F.col("movie_id"))
        bridge = bridge.withColumn("movie_id", hot_key.cast("bigint"))
    parent, bridge = stored("parent", parent), stored("bridge", bridge)
    measures = parent.select(
        "id", parse_date(F.col("release_date")).alias("date_id"), "popularity", "vote_average",
        F.col("vote_count").cast("int"),
    )
    timed("fact_plain_left_join", lambda: run(
        measures.join(bridge, measures.id == bridge.movie_id, "left")))
    timed("fact_joined", lambda: run(build_fact(parent, bridge, m.FACT)))
    fact = build_fact_from_arrays(cleaned, m.ARRAY, m.FACT)
    timed("fact_from_arrays", lambda: run(fact))

    fact = stored("fact", fact)
    fresh_id = F.when(F.col("movie_id") % 2 == 0, F.col("movie_id") + span * copies)
    day = fact.filter(F.col("movie_id") >= span * (copies - 1)).withColumn(
        "movie_id", F.coalesce(fresh_id, "movie_id"))
    day = stored("day", day)
    timed("day_rows_shuffled", lambda: run(new_rows(day, fact.select(*FACT_KEYS), FACT_KEYS)))
    timed("day_rows_broadcast", lambda: run(
        new_rows(day, fact.select(*FACT_KEYS), FACT_KEYS, small=True)))
    loaded = timed("day_load", lambda: incremental_append(day, f"{folder}/fact", FACT_KEYS))
    # As many rows as a day's, with ids from the whole range; every second id is a new one.
    other = F.when(F.col("movie_id") % 2 == 0, -F.col("movie_id") - 1)
    spread = fact.filter(F.pmod(F.xxhash64("movie_id"), F.lit(copies)) == 0)
    spread = stored("spread", spread.withColumn("movie_id", F.coalesce(other, "movie_id")))
    wide = timed("spread_load", lambda: incremental_append(spread, f"{folder}/fact", FACT_KEYS))
    # Loads that all span the whole range of ids, and a batch of 300 films, half of them of one of these loads.
    part = F.pmod(F.xxhash64("movie_id"), F.lit(LOADS))
    slices = fact.withColumn("part", part).repartition(LOADS, "part").sortWithinPartitions("part", "movie_id")
    slices = stored("slices", slices)
    films = slices.filter("part = 3").select("movie_id").distinct().orderBy(F.xxhash64("movie_id", F.lit(1))).limit(300)
    few = slices.filter("part = 3").drop("part").join(F.broadcast(films), "movie_id")
    few = stored("few", few.withColumn("movie_id", F.coalesce(other, "movie_id")).repartition(1))
    rows_read = {}
    for name, lookup in (("plain", ()), ("bloom", ("movie_id",))):
        for i in range(LOADS):
            append_rows(slices.filter(F.col("part") == i).drop("part").coalesce(1), f"{folder}/few_{name}", lookup)
        target = spark.read.parquet(f"{folder}/few_{name}").select("movie_id")
        rows_read[f"{name}_rows"] = target.count()
        rows_read[f"{name}_bytes"] = sum(
            os.path.getsize(f.removeprefix("file://")) for f in spark.read.parquet(f"{folder}/few_{name}").inputFiles())
        lookups = target.filter(load._named_keys(few, "movie_id"))
        timed(f"few_scan_{name}", lookups.collect)
        scan = lookups._jdf.queryExecution().executedPlan().collectLeaves().head()
        rows_read[f"{name}_scanned"] = scan.metrics().apply("numOutputRows").value()
        timed(f"few_load_{name}", lambda: incremental_append(few, f"{folder}/few_{name}", FACT_KEYS))
    spark.stop()
    print(json.dumps({
        "few": rows_read,
        "copies": copies, "hot": hot, "seconds": seconds,
        "day": loaded._asdict(), "spread": wide._asdict(),
    }))


if __name__ == "__main__":
    main()
