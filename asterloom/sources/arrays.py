"""Files that hold one JSON array, read by many tasks.

Where a record begins cannot be told from the middle of a file: a brace there may be text. So each
byte range first sums up, for both cases, what it does to the nesting; a running sum over a file's ranges then tells how each range begins, and with that
each range cuts out its own records. A record that lies across ranges is joined from its parts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPEN, CLOSE, QUOTE, BACKSLASH = b"{}\"\\"
_RANGE = "file long, begins long"


def _ranges(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(file, begins, value)``: the files, each a number, in pieces that each ended in a closing brace.

    Rows of a range follow each other in the order of the file. Every piece is a row, so what
    tells the file is a hash of its path and not the path.
    """
    rows = spark.read.option("lineSep", "}").text(paths if isinstance(paths, str) else list(paths))
    return rows.select(
        F.xxhash64("_metadata.file_path", "_metadata.file_size").alias("file"),
        F.col("_metadata.file_block_start").alias("begins"),
        F.col("value").cast("binary").alias("value"),
    )


def _with_braces(values: pa.BinaryArray) -> np.ndarray:
    """The bytes of all pieces in a row, each with its closing brace again."""
    offsets = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1]
    ends = (offsets[1:] - offsets[0]).astype(np.int64) + np.arange(len(values))
    out = np.empty(int(ends[-1]) + 1, np.uint8)
    own = np.ones(len(out), bool)
    own[ends] = False
    out[ends] = CLOSE
    if values.buffers()[2] is not None:
        out[own] = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return out


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, bool]]:
    """Slices of the batches within one range, their bytes, and whether the range is a new one."""
    before = None
    for batch in batches:
        key = np.stack([batch.column(c).to_numpy() for c in ("file", "begins")])
        cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1).tolist(), len(batch)]
        for low, high in zip(cuts[:-1], cuts[1:]):
            if high > low:
                part, own = batch.slice(low, high - low), tuple(key[:, low])
                yield part, _with_braces(part.column("value")), own != before
                before = own


def _quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that begin or end a text: those behind an even number of backslashes."""
    at, escapes = np.flatnonzero(data == QUOTE), np.flatnonzero(data == BACKSLASH)
    if len(escapes) == 0:
        return at
    place = np.arange(len(escapes))
    first = np.maximum.accumulate(np.where(np.diff(escapes, prepend=-2) > 1, place, 0))
    run = place - first + 1  # backslashes in a row, up to each
    last = np.searchsorted(escapes, at) - 1
    behind = np.where((last >= 0) & (escapes[last] == at - 1), run[last], 0)
    return at[behind % 2 == 0]


def _braces(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Places of all braces, what each does to the nesting, quotes in front of it, and all quotes."""
    at = np.flatnonzero((data == OPEN) | (data == CLOSE))
    quotes = _quotes(data)
    return at, np.where(data[at] == OPEN, 1, -1), np.searchsorted(quotes, at), len(quotes)


def _sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: whether it changes between in and out of a text, and by how much it nests deeper,
    if it begins outside of a text and if within one."""
    names = ["file", "begins", "changes", "outside", "inside"]
    row = None
    for part, data, new in _by_range(batches):
        if new:
            if row is not None:
                yield pa.RecordBatch.from_pylist([row], schema=_sums)
            row = dict.fromkeys(names, 0) | {"file": part.column("file")[0].as_py(), "begins": part.column("begins")[0].as_py()}
        _, step, quotes, n = _braces(data)
        within = (quotes + row["changes"]) % 2 == 1
        row["outside"] += int(step[~within].sum())
        row["inside"] += int(step[within].sum())
        row["changes"] = (row["changes"] + n) % 2
    if row is not None:
        yield pa.RecordBatch.from_pylist([row], schema=_sums)


_sums = pa.schema([("file", pa.int64()), ("begins", pa.int64()), ("changes", pa.int64()), ("outside", pa.int64()), ("inside", pa.int64())])


def _starts(rows: DataFrame) -> DataFrame:
    """``(file, begins, within, depth)``: for each range whether it begins in a text, and how deep. A row per range."""
    sums = rows.mapInArrow(_sum_up, f"{_RANGE}, changes long, outside long, inside long")
    before = Window.partitionBy("file").orderBy("begins").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    known = sums.withColumn("within", total("changes") % 2 == 1)
    known = known.withColumn("depth", total(F.when(F.col("within"), F.col("inside")).otherwise(F.col("outside"))))
    return known.select("file", "begins", "within", "depth")


_cut_schema = pa.schema([("file", pa.int64()), ("begins", pa.int64()), ("part", pa.int32()), ("ends", pa.bool_()), ("record", pa.binary())])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of each range; ``part`` is 0 for whole ones, 1 for what belongs to a record begun in an earlier range
    (``ends``: with its end), 2 for the beginning of one that goes on."""
    own: dict = {}

    def rows(records, part=0, ends=True):
        n = len(records)
        columns = [[own["file"]] * n, [own["begins"]] * n, [part] * n, [ends] * n, records]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _cut_schema)], schema=_cut_schema)

    def rest():
        if own.get("head"):
            yield rows([b"".join(own["head"])], 1, False)
        if own.get("carry"):
            yield rows([own["carry"]], 2, False)

    for part, data, new in _by_range(batches):
        if new:
            yield from rest()
            own = {c: part.column(c)[0].as_py() for c in ("file", "begins", "within", "depth")} | {"head": [], "carry": b""}
            if own["depth"] is None:
                raise ValueError("the ranges of a file changed between two reads of it")
        if own["depth"] > 0:
            at, step, quotes, n = _braces(data)
            outside = (quotes + own["within"]) % 2 == 0
            depth = own["depth"] + np.cumsum(step[outside])
            closed = np.flatnonzero(depth == 0)
            if len(closed) == 0:
                own["head"].append(data.tobytes())
                own["depth"] = int(depth[-1]) if len(depth) else own["depth"]
                own["within"] = (n + own["within"]) % 2 == 1
                continue
            end = int(at[outside][closed[0]]) + 1
            yield rows([b"".join([*own["head"], data[:end].tobytes()])], 1)
            own |= {"depth": 0, "head": []}
            data = data[end:]
        if own["carry"]:
            data = np.concatenate([np.frombuffer(own["carry"], np.uint8), data])
        at, step, quotes, _ = _braces(data)
        outside = quotes % 2 == 0
        at, step = at[outside], step[outside]
        depth = np.cumsum(step)
        begins = at[(depth == 1) & (step == 1)]
        ends = at[(depth == 0) & (step == -1)] + 1
        whole = [data[a:b].tobytes() for a, b in zip(begins.tolist(), ends.tolist())]
        own["carry"] = data[begins[len(ends)] :].tobytes() if len(begins) > len(ends) else b""
        if whole:
            yield rows(whole)
    yield from rest()


def array_records(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(record)``: the text of each record of files that hold JSON arrays of objects, in any number of tasks.

    A record is an outermost object, so a file may also hold a single object, or objects one after
    the other. Braces, quotes and backslashes within texts do not count. Files are UTF-8 and split as Spark
    splits text files; compressed ones are read by one task each. A file that ends within a record gives
    what there is of it as its last record. The files are read three times: to sum up the ranges, for the
    records within ranges, and for those across, which alone are shuffled. What is known of the ranges,
    a short row for each, is sent to all tasks: it grows with the number of splits, not with their size.
    """
    rows = _ranges(spark, paths)
    placed = rows.join(F.broadcast(_starts(rows)), ["file", "begins"], "left")
    cut = placed.mapInArrow(_cut, f"{_RANGE}, part int, ends boolean, record binary")
    across = cut.filter("part > 0")
    # What ended before a part counts the records, so the parts of one have the same number.
    before = Window.partitionBy("file").orderBy("begins", "part").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum(F.col("ends").cast("long")).over(before), F.lit(0))
    parts = F.array_sort(F.collect_list(F.struct("begins", "part", "record")))
    across = across.withColumn("number", number).groupBy("file", "number").agg(parts.alias("parts"))
    joined = F.aggregate("parts", F.lit(b""), lambda text, p: F.concat(text, p["record"]))
    return cut.filter("part = 0").select(_text(F.col("record"))).unionByName(across.select(_text(joined)))


def _text(record: Column) -> Column:
    return record.cast("string").alias("record")


def read_array_records(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | str, **options: str) -> DataFrame:
    """The records of files that hold one JSON array each, whatever their size: see ``array_records``.

    Gives the rows of a ``multiLine`` read of valid files. A malformed record is one row, with nulls where nothing could be read,
    and its text in the corrupt column if the schema has one; the other records of its file are kept.
    """
    return array_records(spark, paths).select(F.from_json("record", schema, options).alias("row")).select("row.*")
