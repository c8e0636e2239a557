import pytest

from asterloom.operators import LoadResult, incremental_append, load, new_rows
from asterloom.plans import movies as m
from asterloom.sinks import append_rows, overwrite_table
from asterloom.sources import read_table, target_keys

from tests.helpers import rows

KEYS = m.TABLE_KEYS["fact_movie_metrics"]
SCHEMA = (
    "movie_id bigint, genre_id bigint, date_id date, popularity double,"
    " vote_average double, vote_count int"
)


@pytest.fixture(params=["broadcast", "shuffled"])
def limit(request, monkeypatch):
    """Key bytes up to which a batch is broadcast, however small the target."""
    monkeypatch.setattr(load, "BROADCAST_TARGET_RATIO", 0)
    return 64 << 20 if request.param == "broadcast" else -1


def facts(spark, *keys, popularity=1.0):
    return spark.createDataFrame([(*k, None, popularity, 2.0, 3) for k in keys], SCHEMA)


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "warehouse" / "fact")


def test_missing_target_is_created(spark, target):
    assert incremental_append(facts(spark, (1, 1), (1, 1)), target, KEYS) == LoadResult(2, 0)
    table = read_table(spark, target)
    assert table.schema == facts(spark).schema
    assert rows(table, *KEYS) == [(1, 1), (1, 1)]


def test_empty_target(spark, target):
    overwrite_table(facts(spark), target)
    assert incremental_append(facts(spark, (1, None)), target, KEYS) == (1, 0)


def test_folder_without_files(spark, target, tmp_path):
    (tmp_path / "warehouse" / "fact").mkdir(parents=True)
    assert incremental_append(facts(spark, (1, 1)), target, KEYS) == (1, 0)
    assert incremental_append(facts(spark, (1, 1)), target, KEYS) == (0, 1)


def test_some_new(spark, target, limit):
    append_rows(facts(spark, (1, 1), (2, None)), target)
    batch = facts(spark, (1, 1), (2, None), (3, 2), (3, 2))
    assert incremental_append(batch, target, KEYS, limit) == (2, 2)
    assert rows(read_table(spark, target), *KEYS) == [(1, 1), (2, None), (3, 2), (3, 2)]


def test_none_new(spark, target, limit):
    batch = facts(spark, (1, 1), (2, None), (None, None), (3, 2), (3, 2))
    assert incremental_append(batch, target, KEYS, limit) == (5, 0)
    assert incremental_append(batch, target, KEYS, limit) == (0, 5)
    assert read_table(spark, target).count() == 5


def test_stored_rows_are_never_updated(spark, target, limit):
    append_rows(facts(spark, (1, 1), popularity=5.0), target)
    batch = facts(spark, (1, 1), popularity=9.0)
    assert incremental_append(batch, target, KEYS, limit) == (0, 1)
    assert read_table(spark, target).first()["popularity"] == 5.0


def test_no_key_appends_everything(spark, target):
    batch = facts(spark, (1, 1), (2, None))
    assert incremental_append(batch, target) == (2, 0)
    assert incremental_append(batch, target) == (2, 0)
    assert read_table(spark, target).count() == 4


@pytest.mark.parametrize("batch_keys", [
    [(None, None)], [(5, None), (6, None)], [(None, 7)], [(-3, 7), (9, 1)], [],
])
def test_against_plain_python(spark, target, limit, batch_keys):
    stored = [(1, 1), (5, None), (None, 7), (9, 1), (9, 1), (10**12, 2)]
    append_rows(facts(spark, *stored), target)
    fresh = [k for k in batch_keys if k not in stored]
    result = incremental_append(facts(spark, *batch_keys), target, KEYS, limit)
    assert result == (len(fresh), len(batch_keys) - len(fresh))
    assert read_table(spark, target).count() == len(stored) + len(fresh)


def dated(spark, *data):
    return spark.createDataFrame(data, "name string, day string").selectExpr(
        "name", "try_to_date(day) AS day"
    )


def test_text_and_date_keys(spark, target, limit):
    """Dates include some that Python cannot hold."""
    append_rows(dated(spark, ("a", "2024"), ("b", None), (None, "20240-01-01")), target)
    batch = dated(
        spark, ("a", "2024"), ("a", None), ("b", None), (None, "20240-01-01"), ("é", "0000-01-01")
    )
    assert incremental_append(batch, target, ["name", "day"], limit) == (2, 3)


def test_catalog_table(spark):
    spark.sql("DROP TABLE IF EXISTS fact_load_test")
    batch = facts(spark, (1, 1), (2, None))
    assert incremental_append(batch, "fact_load_test", KEYS) == (2, 0)
    more = facts(spark, (2, None), (3, 1))
    assert incremental_append(more, "fact_load_test", KEYS) == (1, 1)
    assert rows(target_keys(spark, "fact_load_test", KEYS)) == [(1, 1), (2, None), (3, 1)]
    spark.sql("DROP TABLE fact_load_test")


def test_names_match_in_any_case_and_order(spark, target):
    append_rows(facts(spark, (1, 1)), target)
    batch = facts(spark, (1, 1), (2, 2)).selectExpr(
        "vote_count", "GENRE_ID", "MOVIE_ID", "date_id", "popularity", "vote_average"
    )
    assert incremental_append(batch, target, ["Movie_Id", "genre_id"]) == (1, 1)
    assert read_table(spark, target).columns == facts(spark).columns
    assert rows(read_table(spark, target), *KEYS) == [(1, 1), (2, 2)]


@pytest.mark.parametrize("change", ["drop", "type"])
def test_other_columns_are_refused(spark, target, change):
    append_rows(facts(spark, (1, 1)), target)
    batch = facts(spark, (2, 2))
    if change == "drop":
        batch = batch.drop("vote_count")
    else:
        batch = batch.withColumn("vote_count", batch.vote_count.cast("bigint"))
    with pytest.raises(ValueError, match="vote_count"):
        incremental_append(batch, target, KEYS)
    assert read_table(spark, target).count() == 1


def test_unreadable_target_is_no_missing_target(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "part-0.parquet").write_text("this is no Parquet file")
    with pytest.raises(Exception):
        incremental_append(facts(spark, (1, 1)), str(folder), KEYS)
    assert len(list(folder.glob("*.parquet"))) == 1


@pytest.mark.parametrize("small", [True, False])
def test_new_rows_of_frames_with_common_origin(spark, small):
    batch = facts(spark, (1, 1), (2, None), (3, 3), (3, 3))
    existing = batch.filter("movie_id < 3")
    assert rows(new_rows(batch, existing, KEYS, small), *KEYS) == [(3, 3), (3, 3)]


@pytest.mark.parametrize("rows_there, limit, small", [
    (3, 64 << 20, False), (4, 64 << 20, True), (400, 64 << 20, True), (400, 64, False),
])
def test_when_the_batch_is_broadcast(spark, target, monkeypatch, rows_there, limit, small):
    seen = []

    def spy(batch, existing, keys, small):
        seen.append(small)
        return new_rows(batch, existing, keys, small)

    monkeypatch.setattr(load, "new_rows", spy)
    append_rows(facts(spark, *[(i, i) for i in range(rows_there)]), target)
    assert incremental_append(facts(spark, (-1, -1)), target, KEYS, limit) == (1, 0)
    assert seen == [small]


def test_text_keys_that_are_no_utf8_are_loaded_once(spark, target, limit, tmp_path):
    overwrite_table(spark.sql("SELECT CAST(unhex('FF61') AS STRING) AS name, 1 AS n"), f"{tmp_path}/b")
    batch = read_table(spark, f"{tmp_path}/b")
    assert incremental_append(batch, target, ["name"], limit) == (1, 0)
    assert incremental_append(batch, target, ["name"], limit) == (0, 1)
    mixed = batch.unionByName(spark.createDataFrame([("é", 2), (None, 3)], "name string, n int"))
    assert incremental_append(mixed, target, ["name"], limit) == (2, 1)
    assert read_table(spark, target).count() == 3


def test_small_loads_leave_one_sorted_file_each(spark, target, tmp_path):
    for day in range(20):
        keys = [(day + 20 * i, 1) for i in range(50)]
        assert incremental_append(facts(spark, *keys).repartition(7), target, KEYS) == (50, 0)
    files = sorted((tmp_path / "warehouse" / "fact").glob("part-*"))
    assert 20 <= len(files) <= 21
    for file in files:
        ids = [r.movie_id for r in spark.read.parquet(str(file)).collect()]
        assert ids == sorted(ids)
