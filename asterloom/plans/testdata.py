"""Movie-shaped raw records derived from the ``orders`` and ``lineitem`` tables.

An order becomes a record, its line items the categories of that record. Some records
have no title, some an empty date, some no picture, some come twice, some categories are
null or unknown, and orders without line items have no array at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterloom.plans.movies import GENRES, RECORD_SCHEMA

UNKNOWN_GENRE = 99999
# Category by the part number's remainder: the known ones, an unknown one, null.
GENRE_SLOTS = [genre for genre, _ in GENRES] + [UNKNOWN_GENRE, None]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _genres_per_order(lineitem: DataFrame) -> DataFrame:
    """Order key and category array, built from per-category counts.

    The counts are combined in each task before the shuffle, so an order with very many
    line items does not send them all to one task as a collected list would.
    """
    slot = F.col("l_partkey") % len(GENRE_SLOTS)
    counts = lineitem.groupBy("l_orderkey").agg(
        *[F.count_if(slot == i).alias(f"n{i}") for i in range(len(GENRE_SLOTS))]
    )
    repeated = [
        F.array_repeat(F.lit(genre).cast("bigint"), F.col(f"n{i}").cast("int"))
        for i, genre in enumerate(GENRE_SLOTS)
    ]
    return counts.select("l_orderkey", F.flatten(F.array(*repeated)).alias("genre_ids"))


def _fields() -> dict[str, Column]:
    key = F.col("o_orderkey")
    text = key.cast("string")
    return {
        "id": key,
        "title": F.when(key % 97 != 0, F.concat(F.lit("  "), "o_orderpriority", F.lit(" "), text, F.lit(" "))),
        "original_title": F.concat(F.lit("\t"), "o_orderpriority", F.lit(" "), text, F.lit("  ")),
        "overview": F.concat(F.lit(" status "), "o_orderstatus", F.lit(" ")),
        "original_language": F.when(key % 3 == 0, "en").when(key % 3 == 1, "fr"),
        "release_date": F.when(key % 50 == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
        "popularity": F.col("o_totalprice"),
        "vote_average": (key % 100).cast("double") / 10,
        "vote_count": F.col("o_custkey"),
        "adult": key % 11 == 0,
        "video": key % 13 == 0,
        "poster_path": F.when(key % 7 != 0, F.concat(F.lit("/"), text, F.lit(".jpg"))),
        "backdrop_path": F.when(key % 5 != 0, F.concat(F.lit("/b"), text, F.lit(".jpg"))),
    }


def single_records(spark: SparkSession, sf_dir: str, genres: bool = True) -> DataFrame:
    """One record per order; without the category array if ``genres`` is false."""
    orders = table(spark, sf_dir, "orders")
    fields = {name: column.alias(name) for name, column in _fields().items()}
    if not genres:
        return orders.select(*fields.values())
    arrays = _genres_per_order(table(spark, sf_dir, "lineitem"))
    joined = orders.join(arrays, orders.o_orderkey == arrays.l_orderkey, "left")
    fields["genre_ids"] = F.col("genre_ids")
    return joined.select(*[fields[name] for name in RECORD_SCHEMA.names])


def movie_records(spark: SparkSession, sf_dir: str, genres: bool = True) -> DataFrame:
    """The raw records: those of every twentieth order come twice."""
    copies = F.sequence(F.lit(1), F.when(F.col("id") % 20 == 0, 2).otherwise(1))
    records = single_records(spark, sf_dir, genres)
    return records.withColumn("copy", F.explode(copies)).drop("copy")
