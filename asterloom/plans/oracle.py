"""The queries again as SQL for DuckDB, over the whole test tables."""

from __future__ import annotations

from asterloom.plans.movies import GENRES
from asterloom.plans.queries import (
    DAY_FROM,
    DAY_HELD,
    DAY_TO,
    IMAGE_BASE,
    LOADED_BEFORE,
    ODD_TEXT,
    PAGE_WINDOWS,
)
from asterloom.plans.testdata import GENRE_SLOTS

_SLOT_CASES = " ".join(
    f"WHEN {i} THEN {'NULL' if genre is None else genre}" for i, genre in enumerate(GENRE_SLOTS)
)
_GENRE_ROWS = ", ".join(f"({genre}, '{name}')" for genre, name in GENRES)

_BASE = f"""
WITH genre AS (
  SELECT CAST(genre_id AS BIGINT) AS genre_id, genre_name
  FROM (VALUES {_GENRE_ROWS}) AS v(genre_id, genre_name)),
slots AS (
  SELECT l_orderkey, l_partkey % {len(GENRE_SLOTS)} AS slot,
         CAST(CASE l_partkey % {len(GENRE_SLOTS)} {_SLOT_CASES} END AS BIGINT) AS g
  FROM lineitem),
arrays AS (
  SELECT l_orderkey, list(g ORDER BY slot) AS genre_ids,
         string_agg(coalesce(CAST(g AS VARCHAR), 'null'), ',' ORDER BY slot) AS genres_text
  FROM slots GROUP BY l_orderkey),
single AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 97 <> 0
              THEN '  ' || o_orderpriority || ' ' || CAST(o_orderkey AS VARCHAR) || ' ' END AS title,
         chr(9) || o_orderpriority || ' ' || CAST(o_orderkey AS VARCHAR) || '  ' AS original_title,
         ' status ' || o_orderstatus || ' ' AS overview,
         CASE o_orderkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' END AS original_language,
         genre_ids, genres_text,
         CASE WHEN o_orderkey % 50 = 0 THEN '' ELSE strftime(o_orderdate, '%Y-%m-%d') END
           AS release_date,
         o_totalprice AS popularity,
         CAST(o_orderkey % 100 AS DOUBLE) / 10 AS vote_average,
         o_custkey AS vote_count,
         o_orderkey % 11 = 0 AS adult,
         o_orderkey % 13 = 0 AS video,
         CASE WHEN o_orderkey % 7 <> 0
              THEN '/' || CAST(o_orderkey AS VARCHAR) || '.jpg' END AS poster_path,
         CASE WHEN o_orderkey % 5 <> 0
              THEN '/b' || CAST(o_orderkey AS VARCHAR) || '.jpg' END AS backdrop_path
  FROM orders LEFT JOIN arrays ON o_orderkey = l_orderkey),
raw AS (SELECT * FROM single UNION ALL SELECT * FROM single WHERE id % 20 = 0),
one_per_id AS (
  SELECT * EXCLUDE (rank) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY id ORDER BY CASE WHEN title IS NULL THEN 1 ELSE 0 END) AS rank FROM raw)
  WHERE rank = 1),
cleaned AS (
  SELECT * REPLACE (trim(title, ' ') AS title, trim(original_title, ' ') AS original_title,
                    trim(overview, ' ') AS overview),
         try_cast(release_date AS DATE) AS parsed_date
  FROM one_per_id WHERE id IS NOT NULL AND title IS NOT NULL),
bridge AS (
  SELECT movie_id, genre_id
  FROM (SELECT id AS movie_id, unnest(genre_ids) AS genre_id FROM cleaned)
  WHERE genre_id IS NOT NULL),
fact AS (
  SELECT c.id AS movie_id, b.genre_id, c.parsed_date AS date_id, c.popularity, c.vote_average,
         CAST(c.vote_count AS INTEGER) AS vote_count
  FROM cleaned c LEFT JOIN bridge b ON c.id = b.movie_id),
history AS (SELECT * FROM fact WHERE date_id < DATE '{LOADED_BEFORE}'),
fresh AS (
  SELECT f.* FROM fact f ANTI JOIN history h
  ON f.movie_id = h.movie_id AND coalesce(f.genre_id, -1) = coalesce(h.genre_id, -1)),
month AS (SELECT * FROM fact WHERE date_id >= DATE '{DAY_FROM}' AND date_id < DATE '{DAY_TO}'),
held AS (
  SELECT * FROM fact WHERE date_id IS NULL OR date_id < DATE '{DAY_HELD}' OR date_id >= DATE '{DAY_TO}'),
day_fresh AS (
  SELECT f.* FROM month f ANTI JOIN held h
  ON f.movie_id = h.movie_id AND coalesce(f.genre_id, -1) = coalesce(h.genre_id, -1)),
dates AS (
  SELECT DISTINCT parsed_date AS date_id,
         CAST(year(parsed_date) AS VARCHAR) AS year,
         CAST(month(parsed_date) AS VARCHAR) AS month,
         CAST(day(parsed_date) AS VARCHAR) AS day
  FROM cleaned WHERE parsed_date IS NOT NULL),
entity AS (
  SELECT id AS movie_id, title, original_title, original_language,
         '{IMAGE_BASE}' || poster_path AS poster_url, poster_path, backdrop_path,
         parsed_date AS release_date, adult, video
  FROM cleaned),
catalogue AS (
  SELECT id, title, original_title, parsed_date AS primary_release_date, popularity, vote_average
  FROM cleaned),
per_movie AS (
  SELECT movie_id, max(date_id) AS date_id, max(popularity) AS popularity,
         max(vote_average) AS vote_average, max(vote_count) AS vote_count
  FROM fact GROUP BY movie_id),
pages AS (
  SELECT *, CASE WHEN id % 50 = 0 THEN 0 WHEN id % 20 = 0 THEN 2 ELSE 1 END AS results,
         id % 97 = 0 AS broken, id % 71 = 0 OR id % 89 = 0 AS mistyped
  FROM single),
paged AS (
  SELECT *, greatest(1, len(list_filter(coalesce(genre_ids, []), lambda g: g IS NOT NULL))) AS fact_rows,
         len(list_filter(coalesce(genre_ids, []), lambda g: g = 99999)) AS orphans
  FROM pages WHERE NOT broken AND results > 0 AND title IS NOT NULL)
"""

_RECORD = (
    "id, title, original_title, overview, original_language, release_date, popularity,"
    " vote_average, vote_count, adult, video, poster_path, backdrop_path"
)


def _window(order: str, skip: int, rows: int) -> str:
    column, direction = order.rsplit(".", 1)
    return (
        f"SELECT * FROM (SELECT * FROM catalogue ORDER BY {column} {direction} NULLS LAST, id"
        f" LIMIT {rows} OFFSET {skip})"
    )


def _new_rows(batch: str, target: str) -> str:
    """The batch without the target's keys, as an outer join with the distinct keys."""
    return f"""
        , known AS MATERIALIZED (
          SELECT DISTINCT movie_id, coalesce(genre_id, -1) AS genre, 1 AS found FROM {target})
        SELECT b.movie_id, b.genre_id, b.date_id, b.popularity, b.vote_average, b.vote_count
        FROM {batch} b LEFT JOIN known k
        ON b.movie_id = k.movie_id AND coalesce(b.genre_id, -1) = k.genre WHERE k.found IS NULL"""


_LOADS = {
    "dim_movie": "SELECT count(*) FROM entity",
    "dim_date": "SELECT count(*) FROM dates",
    "dim_genre": "SELECT count(*) FROM genre",
    "fact_movie_metrics": "SELECT count(*) FROM fact",
}

_BODIES = {
    "dedupe_key": f"SELECT {_RECORD}, genres_text FROM one_per_id",
    "require_columns": f"SELECT {_RECORD} FROM raw WHERE id IS NOT NULL AND title IS NOT NULL",
    "trim_columns": (
        "SELECT id, trim(title, ' ') AS title, trim(original_title, ' ') AS original_title,"
        " trim(overview, ' ') AS overview FROM raw"
    ),
    "clean": f"SELECT {_RECORD}, genres_text FROM cleaned",
    "split_parent": f"SELECT {_RECORD} FROM cleaned",
    "explode_bridge": "SELECT movie_id, genre_id FROM bridge",
    "dim_static": (
        "SELECT g.genre_id, g.genre_name, count(b.genre_id) AS bridge_rows"
        " FROM genre g LEFT JOIN bridge b ON g.genre_id = b.genre_id GROUP BY 1, 2"
    ),
    "dim_date": "SELECT * FROM dates",
    "dim_entity": "SELECT * FROM entity",
    "fact": "SELECT * FROM fact",
    "fact_from_arrays": "SELECT * FROM fact",
    "casts": f"""
        SELECT id, d AS date_id, CAST(year(d) AS VARCHAR) AS year,
               CAST(month(d) AS VARCHAR) AS month, CAST(day(d) AS VARCHAR) AS day,
               '{IMAGE_BASE}' || poster_path AS poster_url,
               CAST(popularity AS DOUBLE) AS popularity, CAST(vote_count AS INTEGER) AS vote_count
        FROM (SELECT *, try_cast(release_date AS DATE) AS d FROM raw)""",
    "orphan_categories": (
        "SELECT genre_id, count(*) AS fact_rows FROM fact"
        " WHERE genre_id IS NOT NULL AND genre_id NOT IN (SELECT genre_id FROM genre)"
        " GROUP BY genre_id"
    ),
    **{f"page_window_{name}": _window(order, 40, 100) for name, order in PAGE_WINDOWS.items()},
    "page_window_deep": _window("popularity.desc", 12000, 100),
    "page_window_wrapped": (
        f"{_window('popularity.desc', 160, 40)} UNION ALL {_window('popularity.desc', 0, 40)}"
    ),
    "union_pages": (
        f"{_window('popularity.desc', 0, 60)} UNION ALL {_window('popularity.desc', 40, 40)}"
    ),
    "flatten_pages": f"""
        SELECT {_RECORD}, genres_text
        FROM (SELECT * REPLACE (CASE WHEN NOT mistyped THEN vote_count END AS vote_count),
                     unnest(range(results)) AS copy FROM pages WHERE NOT broken)""",
    "page_report": """
        SELECT count(*) AS pages, count(*) FILTER (WHERE broken) AS broken_pages,
               CAST(sum(CASE WHEN broken THEN 0 ELSE results END) AS BIGINT) AS records
        FROM pages""",
    "new_rows": _new_rows("fact", "history"),
    "new_rows_small": _new_rows("month", "held"),
    "append_day": (
        "SELECT * REPLACE (popularity / 2 AS popularity) FROM held UNION ALL SELECT * FROM day_fresh"
    ),
    "append_spread": f"""
        , spread_held AS (
          SELECT * FROM fact
          WHERE date_id IS DISTINCT FROM DATE '{DAY_FROM}' OR vote_average < 5),
        spread_keys AS MATERIALIZED (
          SELECT DISTINCT movie_id, coalesce(genre_id, -1) AS genre, 1 AS found FROM spread_held)
        SELECT * REPLACE (popularity / 2 AS popularity) FROM spread_held
        UNION ALL
        SELECT f.movie_id, f.genre_id, f.date_id, f.popularity, f.vote_average, f.vote_count
        FROM fact f LEFT JOIN spread_keys k
        ON f.movie_id = k.movie_id AND coalesce(f.genre_id, -1) = k.genre
        WHERE f.date_id = DATE '{DAY_FROM}' AND k.found IS NULL""",
    "target_keys": "SELECT movie_id, genre_id FROM fact",
    "append_first": "SELECT * FROM fact",
    "append_second": (
        "SELECT * REPLACE (popularity / 2 AS popularity) FROM history"
        " UNION ALL SELECT * FROM fresh"
    ),
    "load_retried": (
        "SELECT * REPLACE (popularity / 2 AS popularity) FROM history"
        " UNION ALL SELECT * FROM fresh"
    ),
    "replaced_table": "SELECT * FROM history",
    "append_second_shuffled": (
        "SELECT * REPLACE (popularity / 2 AS popularity) FROM held UNION ALL SELECT * FROM day_fresh"
    ),
    "append_none_new": "SELECT * FROM fact",
    "append_keyless": "SELECT * FROM fact UNION ALL SELECT * FROM fact",
    "append_counts": """
        SELECT target_case, loaded, (SELECT count(*) FROM fact) - loaded AS skipped
        FROM (SELECT 'missing' AS target_case, count(*) AS loaded FROM fact
              UNION ALL SELECT 'none_new', 0
              UNION ALL SELECT 'empty', count(*) FROM fact
              UNION ALL SELECT 'some_new', count(*) FROM fresh
              UNION ALL SELECT 'no_key', count(*) FROM fact)""",
    "quality_counts": """
        SELECT r.n AS raw_rows, c.n AS clean_rows, b.n AS bridge_rows, r.n - c.n AS removed_rows
        FROM (SELECT count(*) AS n FROM raw) r, (SELECT count(*) AS n FROM cleaned) c,
             (SELECT count(*) AS n FROM bridge) b""",
    "rejected_records": """
        SELECT id, 'no id' AS reason, count(*) AS n_rows FROM raw WHERE id IS NULL GROUP BY id
        UNION ALL
        SELECT id, 'no title', count(*) FROM raw WHERE id IS NOT NULL AND title IS NULL GROUP BY id
        UNION ALL
        SELECT id, 'copy', count(*) - 1 FROM raw WHERE id IS NOT NULL AND title IS NOT NULL
        GROUP BY id HAVING count(*) > 1""",
    "json_array_scan": f"SELECT {_RECORD}, genres_text FROM raw",
    "json_array_ranges": (
        f"SELECT {_RECORD}, genres_text"
        f" FROM (SELECT * REPLACE ('{ODD_TEXT[0]}' || overview || '{ODD_TEXT[1]}' AS overview) FROM raw)"
    ),
    "json_round_trip": f"SELECT {_RECORD}, genres_text FROM raw",
    "parquet_round_trip": f"SELECT {_RECORD}, genres_text FROM raw",
    "single_file_round_trip": "SELECT * FROM dates",
    "star_pipeline": "SELECT * FROM fact",
    "star_pipeline_flat": "SELECT * FROM fact",
    "pipeline_report": """
        SELECT 'pages' AS name, count(*) AS n_rows FROM pages
        UNION ALL SELECT 'broken_pages', count(*) FROM pages WHERE broken
        UNION ALL SELECT 'raw', CAST(sum(results) AS BIGINT) FROM pages WHERE NOT broken
        UNION ALL SELECT 'clean', count(*) FROM paged
        UNION ALL SELECT 'removed', (SELECT CAST(sum(results) AS BIGINT) FROM pages WHERE NOT broken)
                                    - (SELECT count(*) FROM paged)
        UNION ALL SELECT 'dim_genre', count(*) FROM genre
        UNION ALL SELECT 'dim_date', count(DISTINCT try_cast(release_date AS DATE)) FROM paged
        UNION ALL SELECT 'dim_movie', count(*) FROM paged
        UNION ALL SELECT 'fact_movie_metrics', CAST(sum(fact_rows) AS BIGINT) FROM paged
        UNION ALL SELECT 'orphans', CAST(sum(orphans) AS BIGINT) FROM paged""",
    "pipeline_counts": " UNION ALL ".join(
        f"SELECT CAST({run} AS INTEGER) AS run, '{name}' AS table_name,"
        f" {loaded} AS loaded, {skipped} AS skipped"
        for name, rows in _LOADS.items()
        for run, loaded, skipped in (
            (1, f"({rows})", "CAST(0 AS BIGINT)"),
            (2, "CAST(0 AS BIGINT)", f"({rows})"),
        )
    ),
    "metrics_by_category": """
        SELECT f.genre_id, any_value(g.genre_name) AS genre_name, count(*) AS fact_rows,
               CAST(sum(CAST(popularity AS DECIMAL(18, 2))) AS DOUBLE) AS popularity,
               CAST(sum(vote_count) AS BIGINT) AS vote_count,
               CAST(sum(CAST(vote_average AS DECIMAL(18, 1))) AS DOUBLE) / count(vote_average)
                 AS vote_average
        FROM fact f LEFT JOIN genre g ON f.genre_id = g.genre_id GROUP BY f.genre_id""",
    "metrics_by_month": """
        SELECT d.year, d.month, count(*) AS movies,
               CAST(sum(CAST(popularity AS DECIMAL(18, 2))) AS DOUBLE) AS popularity
        FROM per_movie m LEFT JOIN dates d ON m.date_id = d.date_id GROUP BY d.year, d.month""",
    "top_entities": """
        SELECT m.movie_id, e.title, m.popularity, m.vote_count
        FROM per_movie m JOIN entity e ON m.movie_id = e.movie_id
        ORDER BY m.popularity DESC NULLS LAST, m.movie_id LIMIT 20""",
    "entity_totals": """
        SELECT count(*) AS movies,
               CAST(sum(CAST(popularity AS DECIMAL(18, 2))) AS DOUBLE) AS popularity,
               CAST(sum(vote_count) AS BIGINT) AS vote_count
        FROM per_movie""",
}

_LINE = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,"
    " l_tax, l_returnflag, l_linestatus, l_shipdate"
)

ORACLE_SQL: dict[str, str] = {name: _BASE + body for name, body in _BODIES.items()} | {
    "dedupe_lines": f"""
        SELECT {_LINE} FROM (
          SELECT *, row_number() OVER (
            PARTITION BY l_orderkey
            ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
                     l_tax, l_returnflag, l_linestatus, l_shipdate) AS rank
          FROM lineitem) WHERE rank = 1""",
    "left_join": """
        SELECT o_orderkey, o_custkey, l_orderkey, l_linenumber, l_quantity
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""",
}
