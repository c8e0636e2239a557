"""Shared by the tests."""

from asterloom.plans.movies import RECORD_SCHEMA


def rows(df, *columns):
    """All rows as a sorted list of tuples; nulls first."""
    df = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in df.collect()), key=order)


def order(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def record(**values):
    return tuple(values.get(name) for name in RECORD_SCHEMA.names)


def records(spark, *values):
    return spark.createDataFrame([record(**v) for v in values], RECORD_SCHEMA)


EDGE_ROWS = [
    dict(id=1, title=" A ", genre_ids=[28, 12, 12, None], release_date="2024-01-02"),
    dict(id=1, title=None, genre_ids=[], release_date=""),
    dict(id=2, title="  ", original_title="\tB\n", genre_ids=[], release_date=""),
    dict(id=None, title="n", genre_ids=[99]),
    dict(id=None, title="n2", genre_ids=[99]),
    dict(id=3, title="C", genre_ids=None, release_date="2024"),
    dict(id=4, title="D", genre_ids=[99999], release_date="garbage"),
    dict(id=5, title="E", genre_ids=[28], release_date="2024-5-3"),
]


def plan(df):
    return df._jdf.queryExecution().toString()


def executed_plan(df):
    """The final adaptive plan of a frame that has been run."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


# Counts given with the test tables: fact is (rows, null category, unknown category,
# null date, checksum); "new" is against the keys of even movie ids.
TESTDATA_SIZES = {
    "0.001": dict(
        raw=1575, clean=1484, bridge=5634, dim_date=1069,
        fact=(5667, 33, 296, 106, 176908338), repeated=470, new=2869,
    ),
    "0.01": dict(
        raw=15750, clean=14845, bridge=56516, dim_date=2397,
        fact=(56855, 339, 2955, 1118, 13706650663), repeated=4890, new=28290,
    ),
    "0.1": dict(
        raw=157500, clean=148453, bridge=564152, dim_date=2405,
        fact=(567473, 3321, 29843, 11278, 1324228754891), repeated=49600, new=283398,
    ),
}
