import pytest

from asterloom.plans import movies as m
from asterloom.plans import queries
from asterloom.plans.pipeline import Layout, parent_and_bridge, run_from_pages, run_pipeline
from asterloom.sources import read_pages, read_table

from tests.helpers import EDGE_ROWS, records, rows

MODEL = m.movie_model("https://images.example.org/w500")
FIRST = {"dim_movie": (5, 0), "dim_date": (3, 0), "dim_genre": (18, 0), "fact_movie_metrics": (7, 0)}


@pytest.fixture
def layout(tmp_path):
    return Layout.under(str(tmp_path))


def test_run_twice(spark, layout):
    raw = records(spark, *EDGE_ROWS)
    result = run_pipeline(raw, layout, MODEL)
    assert result.counts == {
        "raw": 8,
        "clean": 5,
        "removed": 3,
        "dim_genre": 18,
        "dim_date": 3,
        "dim_movie": 5,
        "fact_movie_metrics": 7,
        "orphans": 1,
    }
    assert result.loads == FIRST
    again = run_pipeline(raw, layout, MODEL)
    assert again.counts == result.counts
    assert again.loads == {table: (0, loaded) for table, (loaded, _) in FIRST.items()}
    for table, (loaded, _) in FIRST.items():
        assert read_table(spark, f"{layout.target}/{table}").count() == loaded


def test_pipeline_counts_derives_its_records_once(spark, sf_dir, monkeypatch):
    calls, derive = [], queries.movie_records
    monkeypatch.setattr(queries, "movie_records", lambda *args: calls.append(args) or derive(*args))
    counts = {(r.run, r.table_name): (r.loaded, r.skipped) for r in queries.pipeline_counts(spark, sf_dir).collect()}
    assert len(calls) == 1
    first, second = ([counts[run, table] for table in m.TABLE_KEYS] for run in (1, 2))
    assert all(loaded and not skipped for loaded, skipped in first)
    assert second == [(0, loaded) for loaded, _ in first]


def test_next_day_adds_and_keeps(spark, layout):
    run_pipeline(records(spark, *EDGE_ROWS), layout, MODEL)
    news = [
        dict(id=1, title="changed", genre_ids=[28, 35], release_date="2024-01-02"),
        dict(id=6, title="F", genre_ids=[12], release_date="2024-06-01"),
    ]
    result = run_pipeline(records(spark, *news), layout, MODEL)
    assert result.loads == {
        "dim_movie": (1, 1),
        "dim_date": (1, 1),
        "dim_genre": (0, 18),
        "fact_movie_metrics": (2, 1),
    }
    movies = read_table(spark, f"{layout.target}/dim_movie")
    assert rows(movies, "movie_id", "title")[0] == (1, "A")
    layer, bridge = parent_and_bridge(spark, layout, MODEL)
    assert rows(layer, "id", "title") == [(1, "changed"), (6, "F")]
    assert m.ARRAY not in layer.columns and bridge.count() == 3


def test_flat_model_joins_stored_tables(spark, tmp_path):
    raw = records(spark, *EDGE_ROWS)
    nested = run_pipeline(raw, Layout.under(f"{tmp_path}/nested"), MODEL)
    flat = run_pipeline(raw, Layout.under(f"{tmp_path}/flat"), m.movie_model("https://images.example.org/w500", flat=True))
    assert flat.counts == nested.counts | {"movies_clean": 5, "genres_clean": 5}
    facts = [rows(read_table(spark, f"{tmp_path}/{x}/target/fact_movie_metrics")) for x in ("nested", "flat")]
    assert facts[0] == facts[1]


def test_run_from_pages(spark, layout):
    (layout_root,) = {layout.raw.removesuffix("/raw")}
    lines = ['{"page": 1, "results": [{"id": 1, "title": "a", "genre_ids": [28, 7]}]}', '{"page": 2, "res', '{"page": 3}']
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(f"{layout_root}/pages")
    pages = read_pages(spark, f"{layout_root}/pages", m.RECORD_SCHEMA, multiline=False)
    counts = run_from_pages(pages, layout, MODEL, load=False).counts
    assert (counts["pages"], counts["broken_pages"], counts["raw"], counts["orphans"]) == (3, 1, 1, 1)
    with pytest.raises(ValueError, match="no rows"):
        run_from_pages(pages.filter("page = 3"), layout, MODEL)


def test_load_can_be_switched_off(spark, layout, tmp_path):
    result = run_pipeline(records(spark, *EDGE_ROWS), layout, MODEL, load=False)
    assert result.loads == {} and result.counts["fact_movie_metrics"] == 7
    assert not (tmp_path / "target").exists()


def test_nothing_to_do_fails_before_the_raw_layer_is_replaced(spark, layout, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        run_pipeline(records(spark), layout, MODEL)
    assert not (tmp_path / "raw").exists()
