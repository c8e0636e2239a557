"""Every query against its SQL in DuckDB, and against counts known beforehand."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from asterloom.operators import new_rows
from asterloom.plans import movies as m
from asterloom.plans import queries as q
from asterloom.plans.oracle import ORACLE_SQL
from asterloom.plans.testdata import movie_records
from pyspark.sql import functions as F

from tests.helpers import TESTDATA_SIZES, order

TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder):
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def hot_dir(sf_dir, tmp_path_factory):
    """A third of the orders are copies of one, a third of the line items are another's."""
    folder = str(tmp_path_factory.mktemp("hot"))
    with connect(sf_dir) as source:
        source.execute(
            "COPY (SELECT * FROM orders UNION ALL"
            " SELECT o.* FROM orders o, range(750) WHERE o_orderkey = 11)"
            f" TO '{folder}/orders.parquet'"
        )
        source.execute(
            "COPY (SELECT * REPLACE (CASE WHEN hash(l_orderkey, l_linenumber, l_partkey) % 3 = 0"
            " THEN 12 ELSE l_orderkey END AS l_orderkey) FROM lineitem)"
            f" TO '{folder}/lineitem.parquet'"
        )
    return folder


def compare(spark, connection, folder, name):
    df = contract.queries()[name](spark, folder)
    relation = connection.sql(contract.oracle_sql()[name])
    columns = sorted(df.columns)
    assert columns == sorted(relation.columns)
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    places = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in places) for r in relation.fetchall()), key=order)
    actual = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=order)
    assert actual == expected


def test_every_query_has_sql():
    assert q.QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", q.QUERIES)
def test_query_matches_sql(spark, duck, sf_dir, name):
    compare(spark, duck, sf_dir, name)


@pytest.mark.parametrize("name", [
    "dedupe_key", "clean", "explode_bridge", "dim_static", "fact", "fact_from_arrays",
    "left_join", "new_rows", "append_second", "append_second_shuffled", "quality_counts",
    "pipeline_counts", "union_pages", "entity_totals",
])
def test_query_matches_sql_with_hot_keys(spark, hot_dir, name):
    compare(spark, connect(hot_dir), hot_dir, name)


def test_entry(spark):
    assert contract.entry(spark).count() == 5667


@pytest.mark.parametrize("size", TESTDATA_SIZES)
def test_known_counts(spark, size):
    sf_dir, known = f"/root/testdata/sf{size}", TESTDATA_SIZES[size]
    if not os.path.isdir(sf_dir):
        pytest.skip("no test tables")
    fact = q.QUERIES["star_pipeline"](spark, sf_dir)
    genres = [g for g, _ in m.GENRES]
    keys = F.struct("movie_id", "genre_id")
    counts = fact.agg(
        F.count(F.lit(1)),
        F.count_if(F.col("genre_id").isNull()),
        F.count_if(~F.col("genre_id").isin(genres)),
        F.count_if(F.col("date_id").isNull()),
        F.sum(F.col("movie_id") * 31 + F.coalesce("genre_id", F.lit(-1))),
    ).first()
    repeated = fact.groupBy(keys.alias("k")).count().filter("count > 1").count()
    fresh = new_rows(fact, fact.filter("movie_id % 2 = 0"), m.TABLE_KEYS["fact_movie_metrics"])
    quality = q.QUERIES["quality_counts"](spark, sf_dir).first()
    assert movie_records(spark, sf_dir).count() == known["raw"]
    assert quality["raw_rows"] == known["raw"]
    assert quality["clean_rows"] == known["clean"]
    assert quality["bridge_rows"] == known["bridge"]
    assert q.QUERIES["dim_date"](spark, sf_dir).count() == known["dim_date"]
    assert tuple(counts) == known["fact"]
    assert repeated == known["repeated"]
    assert fresh.count() == known["new"]
