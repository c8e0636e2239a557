"""What the plans must look like to hold at scale, and hot keys in particular."""

import re

import pytest
from pyspark.sql import functions as F

from asterloom.operators import (
    build_fact,
    build_fact_from_arrays,
    clean,
    date_dimension,
    entity_dimension,
    incremental_append,
    keep_one,
    left_join_children,
    new_rows,
    orphans,
    split_array,
    static_dimension,
)
from asterloom.plans import movies as m
from asterloom.plans.testdata import movie_records
from asterloom.sinks import append_rows, overwrite_table
from asterloom.sources import page_window, read_table, target_keys

from tests.helpers import executed_plan, rows

KEYS = m.TABLE_KEYS["fact_movie_metrics"]


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Raw, cleaned, parent, bridge and fact as stored tables."""
    root = str(tmp_path_factory.mktemp("stored"))
    tables = {}

    def put(name, df):
        overwrite_table(df, f"{root}/{name}")
        tables[name] = read_table(spark, f"{root}/{name}")

    put("raw", movie_records(spark, sf_dir))
    put("cleaned", clean(tables["raw"], [m.KEY], m.REQUIRED, m.TRIMMED))
    parent, bridge = split_array(tables["cleaned"], m.KEY, m.ARRAY, m.PARENT_KEY, m.ELEMENT)
    put("parent", parent)
    put("bridge", bridge)
    put("fact", build_fact_from_arrays(tables["cleaned"], m.ARRAY, m.FACT))
    return tables


@pytest.fixture
def no_broadcast(with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")


@pytest.fixture
def split_early(with_conf, no_broadcast):
    """Make adaptive execution split partitions of this size of data."""
    with_conf(
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )


def exchanges(plan):
    lines = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    return len([line for line in lines if "ReusedExchange" not in line])


def test_clean_filters_in_the_scan_and_ranks_before_the_shuffle(stored):
    plan = executed_plan(clean(stored["raw"], [m.KEY], m.REQUIRED, m.TRIMMED))
    assert "PushedFilters: [IsNotNull(id), IsNotNull(title)]" in plan
    assert re.search(r"Final.*Exchange hashpartitioning.*Partial", plan, re.S)
    assert exchanges(plan) == 1


def test_bridge_scan_reads_two_columns(stored):
    _, bridge = split_array(stored["cleaned"], m.KEY, m.ARRAY, m.PARENT_KEY, m.ELEMENT)
    plan = executed_plan(bridge)
    assert "ReadSchema: struct<id:bigint,genre_ids:array<bigint>>" in plan
    assert "Exchange" not in plan


def test_date_dimension_reads_one_column_and_reduces_first(stored):
    plan = executed_plan(date_dimension(stored["parent"], "release_date"))
    assert "ReadSchema: struct<release_date:string>" in plan
    assert re.search(r"HashAggregate.*Exchange.*HashAggregate", plan, re.S)
    assert exchanges(plan) == 1


def test_entity_dimension_does_not_shuffle(stored):
    plan = executed_plan(entity_dimension(stored["parent"], m.entity_spec("x")))
    assert "Exchange" not in plan


def test_fact_from_arrays_neither_joins_nor_shuffles(stored):
    plan = executed_plan(build_fact_from_arrays(stored["cleaned"], m.ARRAY, m.FACT))
    assert "Exchange" not in plan and "Join" not in plan


def test_fact_shuffles_the_parents_once(stored, no_broadcast):
    fact = build_fact(stored["parent"], stored["bridge"], m.FACT)
    plan = executed_plan(fact)
    assert plan.count("ReusedExchange") == 1
    # parents, bridge rows, distinct bridge keys
    assert exchanges(plan) == 3
    assert rows(fact) == rows(stored["fact"])


def test_page_window_is_a_top_k(stored):
    plan = executed_plan(page_window(stored["parent"], "popularity.desc", "id", 2, 3))
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan


def test_orphans_reduce_before_the_join(spark, stored):
    genres = static_dimension(spark, m.GENRES, m.GENRE_SCHEMA)
    plan = executed_plan(orphans(stored["fact"], genres, m.ELEMENT))
    assert "ReadSchema: struct<genre_id:bigint>" in plan
    assert plan.index("Join") < plan.index("HashAggregate")


def test_small_batch_does_not_shuffle_the_target(stored, no_broadcast):
    batch, target = stored["fact"].filter("movie_id < 100"), stored["fact"].select(*KEYS)
    plan = executed_plan(new_rows(batch, target, KEYS, small=True))
    assert plan.count("BroadcastHashJoin") == 2
    assert "SortMergeJoin" not in plan
    assert "ReadSchema: struct<movie_id:bigint,genre_id:bigint>" in plan


def test_target_scan_is_cut_to_the_range_of_the_batch(spark, stored, tmp_path, monkeypatch):
    from asterloom.operators import load

    seen = []
    monkeypatch.setattr(load, "append_rows", lambda df, *_: seen.append(df) or 0)
    target = str(tmp_path / "target")
    append_rows(stored["fact"].filter("movie_id % 20 <> 3"), target)
    incremental_append(stored["fact"].filter("movie_id between 40 and 90"), target, KEYS)
    plan = executed_plan(seen[0])
    # One scan is the target's, the others are the batch's.
    assert re.search(r"PushedFilters: \[Or\(IsNull\(movie_id\),And\(GreaterThanOrEqual", plan)


# --- one key holds a third of all rows ------------------------------------------------


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """60,000 rows, a third of them under key 7, in 8 files."""
    root = str(tmp_path_factory.mktemp("hot"))
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000 + 10).cast("bigint")
    df = spark.range(0, 60000, 1, 8).select(
        key.alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.col("id").alias("n")
    )
    overwrite_table(df, f"{root}/rows")
    overwrite_table(spark.range(0, 1200).selectExpr("id AS p", "id * 2 AS w"), f"{root}/keys")
    return read_table(spark, f"{root}/rows"), read_table(spark, f"{root}/keys")


def test_hot_child_key_is_split_in_the_left_join(hot, split_early):
    children, parents = hot
    joined = left_join_children(parents, children, "p", "k")
    plan = executed_plan(joined)
    assert "SortMergeJoin(skew=true)" in plan
    plain = parents.join(children, parents.p == children.k, "left")
    assert joined.columns == plain.columns
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()


def test_hot_batch_key_is_split_in_the_anti_join(hot, split_early):
    batch, keys = hot
    existing = keys.selectExpr("p + 500 AS k")
    fresh = new_rows(batch, existing, ["k"])
    assert "SortMergeJoin(skew=true)" in executed_plan(fresh)
    plain = batch.join(existing, "k", "left_anti")
    assert fresh.count() == plain.count() > 20000
    assert fresh.exceptAll(plain).isEmpty()


@pytest.mark.parametrize("small", [True, False])
def test_hot_target_key_is_reduced_before_its_shuffle(hot, no_broadcast, small):
    existing, keys = hot
    fresh = new_rows(keys.selectExpr("p AS k", "w"), existing, ["k"], small)
    plan = executed_plan(fresh)
    assert re.search(r"HashAggregate.*Exchange.*HashAggregate", plan, re.S)
    assert rows(fresh, "k") == [(i,) for i in range(1200) if i != 7 and not 10 <= i < 1010]


def test_hot_key_sends_one_row_per_task_to_the_shuffle(hot):
    df, _ = hot
    kept = keep_one(df, ["k"], tie_break=["n"])
    assert kept.filter("k = 7").collect()[0]["n"] == 0
    plan = executed_plan(kept)
    assert re.search(r"Final.*Exchange hashpartitioning.*WindowGroupLimit.*Partial", plan, re.S)


def test_null_key_may_be_hot_too(hot):
    df, _ = hot
    nulls = df.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    assert keep_one(nulls, ["k"]).count() == 1001
    assert clean(nulls, ["k"], ["k", "n"], ["v"]).count() == 1000
    target = nulls.select("k")
    assert new_rows(nulls, target, ["k"]).isEmpty()
    assert new_rows(nulls, target, ["k"], small=True).isEmpty()
