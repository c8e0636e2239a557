import json

import pytest

from asterloom.operators import clean, require_non_empty
from asterloom.plans import movies as m
from asterloom.sinks import (
    new_scratch_dir,
    overwrite_single_file,
    overwrite_table,
    write_records,
    writers,
)
from asterloom.sources import (
    concat_pages,
    flatten_pages,
    page_report,
    page_window,
    read_pages,
    read_records,
    read_table,
)
from pyspark.sql import types as T

from tests.helpers import records, rows

RECORD = (
    T.StructType()
    .add("id", T.LongType())
    .add("title", T.StringType())
    .add("genre_ids", T.ArrayType(T.LongType()))
)
TWO = {"page": 1, "results": [
    {"id": 1, "title": "a", "genre_ids": [28]}, {"id": 2, "title": "é", "genre_ids": []},
]}
CUT = '{"page": 3, "results": [{"id": 7, "title": "x", "genre_ids": [1]}, {"id": 8, "ti'
MISTYPED = {"page": 5, "results": [{"id": "no number", "title": "x"}, {"id": 9, "title": "y"}]}


def put(folder, **files):
    folder.mkdir(parents=True, exist_ok=True)
    for name, content in files.items():
        text = content if isinstance(content, str) else json.dumps(
            content, indent=2, ensure_ascii=False
        )
        (folder / f"{name}.json").write_text(text, encoding="utf-8")
    return str(folder)


def test_pages_in_files(spark, tmp_path):
    path = put(tmp_path / "p", a=TWO, b={"page": 2}, c=CUT, d={"page": 4, "results": []})
    pages = read_pages(spark, path, RECORD)
    assert rows(flatten_pages(pages), "id", "title") == [(1, "a"), (2, "é")]
    assert rows(page_report(pages)) == [(4, 1, 2)]


def test_pages_in_lines(spark, tmp_path):
    lines = "\n".join([json.dumps(TWO), CUT, json.dumps({"page": 2})])
    path = put(tmp_path / "p", a=lines)
    pages = read_pages(spark, path, RECORD, multiline=False)
    assert rows(flatten_pages(pages), "id") == [(1,), (2,)]
    assert rows(page_report(pages)) == [(3, 1, 2)]


def test_a_mistyped_field_does_not_lose_the_page(spark, tmp_path):
    pages = read_pages(spark, put(tmp_path / "p", a=MISTYPED, b=CUT), RECORD)
    assert rows(flatten_pages(pages), "id", "title") == [(None, "x"), (9, "y")]
    assert rows(page_report(pages)) == [(2, 1, 2)]


def test_a_repeated_field_does_not_lose_the_page(spark, tmp_path):
    both = '{"page": 6, "results": [{"id": "x", "title": "a"}, {"id": 2, "title": "b"}], "page": 6}'
    twice = '{"page": 7, "results": [{"id": 3, "title": "c"}], "page": 7}'
    pages = read_pages(spark, put(tmp_path / "p", a=both, b=twice, c=CUT), RECORD)
    assert rows(flatten_pages(pages), "id", "title") == [(None, "a"), (2, "b"), (3, "c")]
    assert rows(page_report(pages)) == [(3, 1, 3)]


def test_guard_on_pages_without_records(spark, tmp_path):
    pages = read_pages(spark, put(tmp_path / "p", c=CUT, d={"page": 4, "results": []}), RECORD)
    with pytest.raises(ValueError):
        require_non_empty(flatten_pages(pages))


def test_several_page_paths_are_one_bag(spark, tmp_path):
    a, b = put(tmp_path / "a", x=TWO), put(tmp_path / "b", x=TWO)
    assert rows(flatten_pages(read_pages(spark, [a, b], RECORD)), "id") == [(1,), (1,), (2,), (2,)]


def test_json_array_file(spark, tmp_path):
    path = put(tmp_path / "r", a=TWO["results"])
    given = read_records(spark, path, RECORD)
    assert rows(given, "id", "title") == [(1, "a"), (2, "é")]
    inferred = read_records(spark, path)
    assert inferred.dtypes == [("genre_ids", "array<bigint>"), ("id", "bigint"), ("title", "string")]
    assert rows(inferred, "id", "title") == rows(given, "id", "title")


def test_empty_and_malformed_json_files(spark, tmp_path):
    path = put(tmp_path / "r", a=TWO["results"], b=[], c="[{")
    df = read_records(spark, path, RECORD)
    assert clean(df, ["id"], ["id", "title"], ["title"]).count() == 2


def test_json_landing_replaces_and_round_trips(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = records(
        spark,
        dict(id=1, title=" ü ", genre_ids=[1, None, 1], popularity=0.1, adult=True),
        dict(id=2, genre_ids=[], release_date=""),
    )
    assert write_records(df.union(df), path) == 4
    assert write_records(df, path) == 2
    back = read_records(spark, path, m.RECORD_SCHEMA, multiline=False)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_landed_files_are_compressed_and_of_bounded_length(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    df = records(spark, *[dict(id=i, title=f"  film {i} ", genre_ids=[i % 7, 12]) for i in range(1000)]).coalesce(1)
    df.write.json(f"{tmp_path}/plain")
    size = lambda folder: sum(f.stat().st_size for f in (tmp_path / folder).glob("part-*"))
    assert write_records(df, path) == 1000
    assert 4 * size("raw") < size("plain")
    monkeypatch.setattr(writers, "LANDED_RECORDS", 300)
    assert write_records(df, path) == 1000
    back = read_records(spark, path, m.RECORD_SCHEMA, multiline=False)
    assert len(back.inputFiles()) == 4
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_parquet_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(100).repartition(4)
    assert overwrite_table(df, path) == 100
    assert overwrite_single_file(df.filter("id < 10"), path) == 10
    assert rows(read_table(spark, path)) == [(i,) for i in range(10)]
    files = list((tmp_path / "t").glob("*.parquet"))
    assert len(files) == 1 and files[0].name.endswith(".snappy.parquet")
    assert overwrite_table(df.filter("id < 0"), path) == 0
    assert read_table(spark, path, ["id"]).dtypes == [("id", "bigint")]


@pytest.fixture
def catalogue(spark):
    data = [(i, None if i % 5 == 0 else i % 3, f"t{i:02d}") for i in range(1, 31)]
    return spark.createDataFrame(data, "id int, score int, name string").repartition(4)


def expected(order, first, last, size=4):
    data = [(i, None if i % 5 == 0 else i % 3) for i in range(1, 31)]
    sign = -1 if order == "desc" else 1
    data.sort(key=lambda r: (r[1] is None, sign * (r[1] or 0), r[0]))
    return sorted(r[0] for r in data[(first - 1) * size : last * size])


@pytest.mark.parametrize("order", ["asc", "desc"])
@pytest.mark.parametrize("start, pages", [(1, 1), (2, 3), (7, 2), (1, 8)])
def test_page_window(catalogue, order, start, pages):
    window = page_window(catalogue, f"score.{order}", "id", start, pages, page_size=4)
    assert [r[0] for r in rows(window, "id")] == expected(order, start, start + pages - 1)


def test_page_window_wraps(catalogue):
    window = page_window(catalogue, "score.asc", "id", 5, 3, page_size=4, last_page=6)
    parts = expected("asc", 5, 6) + expected("asc", 1, 1)
    assert [r[0] for r in rows(window, "id")] == sorted(parts)


@pytest.mark.parametrize("order, start, pages", [
    ("score", 1, 1), ("score.up", 1, 1), ("score.asc", 0, 1), ("score.asc", 1, 501),
    ("score.asc", 501, 1),
])
def test_page_window_rejects(catalogue, order, start, pages):
    with pytest.raises(ValueError):
        page_window(catalogue, order, "id", start, pages, last_page=500)


@pytest.mark.parametrize("order", ["asc", "desc"])
@pytest.mark.parametrize("start, pages", [(1, 1), (2, 3), (6, 2), (7, 2), (1, 8), (9, 3)])
def test_deep_windows_are_the_same(catalogue, order, start, pages):
    window = page_window(catalogue, f"score.{order}", "id", start, pages, page_size=4, top_rows=0)
    assert [r[0] for r in rows(window, "id")] == expected(order, start, start + pages - 1)


def test_no_last_page_by_default(spark):
    frame = spark.range(60_000).repartition(16)
    window = page_window(frame, "id.asc", "id", 2501, 2)
    assert [r[0] for r in rows(window)] == list(range(50_000, 50_040))
    # Of 60,000 rows only those of the ranges that the window touches are gathered.
    assert window.sparkSession.read.parquet(window.inputFiles()[0].rsplit("/", 1)[0]).count() == 60_000
    plan = window._jdf.queryExecution().optimizedPlan().toString()
    assert " IN " in plan or "=" in plan


def test_concat_keeps_duplicates_and_matches_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1), ("y", 2)], "s string, n int")
    assert rows(concat_pages(a, b)) == [(1, "x"), (1, "x"), (2, "y")]


def test_scratch_folder_is_under_the_shared_one(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = new_scratch_dir(spark), new_scratch_dir(spark)
    assert first.startswith(base + "/") and first != second
