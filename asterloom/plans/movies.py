"""The movie catalogue as one configuration of the operators."""

from __future__ import annotations

from pyspark.sql import types as T

from asterloom.operators import EntitySpec, FactSpec
from asterloom.plans.pipeline import StarModel

# Category ids and names.
GENRES = [
    (28, "Action"),
    (12, "Adventure"),
    (16, "Animation"),
    (35, "Comedy"),
    (80, "Crime"),
    (99, "Documentary"),
    (18, "Drama"),
    (14, "Fantasy"),
    (36, "History"),
    (27, "Horror"),
    (10402, "Music"),
    (9648, "Mystery"),
    (10749, "Romance"),
    (878, "Science Fiction"),
    (10770, "TV Movie"),
    (53, "Thriller"),
    (10752, "War"),
    (37, "Western"),
]

# Orders in which the catalogue can be paged.
PAGE_ORDERS = [
    "primary_release_date.desc",
    "vote_average.desc",
    "popularity.desc",
    "original_title.asc",
]

# Warehouse tables and their keys.
TABLE_KEYS = {
    "dim_movie": ["movie_id"],
    "dim_date": ["date_id"],
    "dim_genre": ["genre_id"],
    "fact_movie_metrics": ["movie_id", "genre_id"],
}

# Columns and types of the categories and of the raw records.
GENRE_SCHEMA = "genre_id bigint, genre_name string"

RECORD_SCHEMA = (
    T.StructType()
    .add("id", T.LongType())
    .add("title", T.StringType())
    .add("original_title", T.StringType())
    .add("overview", T.StringType())
    .add("original_language", T.StringType())
    .add("genre_ids", T.ArrayType(T.LongType()))
    .add("release_date", T.StringType())
    .add("popularity", T.DoubleType())
    .add("vote_average", T.DoubleType())
    .add("vote_count", T.LongType())
    .add("adult", T.BooleanType())
    .add("video", T.BooleanType())
    .add("poster_path", T.StringType())
    .add("backdrop_path", T.StringType())
)

# Columns of the data contract and what is asked of them.
KEY = "id"
REQUIRED = ("id", "title")
TRIMMED = ("title", "original_title", "overview")
ARRAY = "genre_ids"
PARENT_KEY = "movie_id"
ELEMENT = "genre_id"

FACT = FactSpec(
    parent_key=KEY,
    bridge_key=PARENT_KEY,
    category=ELEMENT,
    date="release_date",
    date_as="date_id",
    doubles=("popularity", "vote_average"),
    ints=("vote_count",),
)


def entity_spec(image_base: str) -> EntitySpec:
    """Movie dimension; ``image_base`` is put in front of the poster path."""
    return EntitySpec(
        # Columns of the movie dimension.
        columns=(
            "movie_id",
            "title",
            "original_title",
            "original_language",
            "poster_url",
            "poster_path",
            "backdrop_path",
            "release_date",
            "adult",
            "video",
        ),
        renamed={"movie_id": KEY},
        prefixes={"poster_url": (image_base, "poster_path")},
        dates=("release_date",),
    )


def movie_model(image_base: str, flat: bool = False) -> StarModel:
    return StarModel(
        flat=flat,
        record_schema=RECORD_SCHEMA,
        key=KEY,
        required=REQUIRED,
        trimmed=TRIMMED,
        array=ARRAY,
        parent_key=PARENT_KEY,
        element=ELEMENT,
        static_rows=GENRES,
        static_schema=GENRE_SCHEMA,
        date="release_date",
        entity=entity_spec(image_base),
        fact=FACT,
        table_keys=TABLE_KEYS,
        # Table names.
        tables={
            "parent": "movies_clean",
            "bridge": "genres_clean",
            "static": "dim_genre",
            "date": "dim_date",
            "entity": "dim_movie",
            "fact": "fact_movie_metrics",
        },
    )
