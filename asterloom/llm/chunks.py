"""Documents in chunks, and which of the chunks' hashes stand more than once in the corpus.

A chunk is one row with the bytes of some documents. Chunks are written once, so that later
passes, and tasks that are run again, see the same chunks in the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm import kernels as k
from asterloom.sinks.scratch import new_scratch_dir

#: A little below a power of two, to which the tables of powers are rounded up.
CHUNK_BYTES = 2_000_000
#: Documents that Spark hands to Python at a time; its default of 10,000 takes too much memory.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


#: Whether the shuffle files of a query go when it ends, not when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to a size that suits rows with whole documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def stage(df: DataFrame, purpose: str, small: bool = False) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back, with its lineage cut.

    ``small`` tells that the rows are few beside what they are made from: they are brought
    together first, so that not every task leaves a file. The shuffle files behind the frame go
    as soon as it is written, as nothing reads them again.
    """
    spark = df.sparkSession
    path = new_scratch_dir(spark, purpose)
    df = df.hint("rebalance") if small else df
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0))).first()[0]


def arrow_schema(fields) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType(fields))


def by_position(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame with columns named by position, so that equal names cannot clash."""
    names = df.columns
    return df.toDF(*[f"c{i}" for i in range(len(names))]), names


def squeeze(data: np.ndarray) -> bytes:
    """Bytes, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(data).data)


def unsqueeze(value: pa.Scalar) -> np.ndarray:
    """The bytes of ``squeeze``."""
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(value.as_buffer()), np.uint8)


def write_chunks(docs: DataFrame, text: str) -> DataFrame:
    """The chunks of the documents, written: the same chunks for each pass over them."""
    return stage(chunked(docs, text), "chunks")


def chunked(docs: DataFrame, text: str, size: int = CHUNK_BYTES) -> DataFrame:
    """``(chunk, rows, lengths, text)``: chunks of about ``size`` bytes of whole documents.

    The text is compressed, which halves what is shuffled and held in rows. ``rows`` has the documents' other columns, ``lengths`` the bytes of each text (null text:
    null, counted as empty). A document longer than ``size`` makes a chunk of its own.
    """
    others = T.StructType([f for f in docs.schema.fields if f.name != text])
    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("rows", T.ArrayType(others)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("text", T.BinaryType()),
        ]
    )
    packed = docs.select(F.struct(*[F.col(f"`{f.name}`") for f in others]).alias("row"), F.col(f"`{text}`").alias("text"))
    out = arrow_schema(schema.fields)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        number, held, size_held = 0, [], 0

        def flush():
            nonlocal number, held, size_held
            if not held:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            lengths = pa.compute.binary_length(table.column("text")).cast(pa.int64()).combine_chunks()
            data, _ = k.flatten(table.column("text"))
            row = table.column("row").combine_chunks()
            one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            columns = [
                pa.array([base + number], pa.int64()),
                one(row).cast(out.field("rows").type),
                one(lengths),
                pa.array([squeeze(data)], pa.binary()),
            ]
            number += 1
            held, size_held = [], 0
            k.release_memory()
            yield pa.RecordBatch.from_arrays(columns, schema=out)

        for batch in batches:
            ends = np.cumsum(pa.compute.binary_length(batch.column("text").fill_null("")).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(batch):
                before = int(ends[at - 1]) if at else 0
                to = int(np.searchsorted(ends, before + size - size_held, "right"))
                to = max(to, at + (0 if held else 1))
                if to > at:
                    held.append(batch.slice(at, to - at))
                    size_held += int(ends[to - 1]) - before
                if to < len(batch) or size_held >= size:
                    yield from flush()
                at = to
        yield from flush()

    return packed.mapInArrow(pack, schema)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An array with the bytes between neighbouring offsets."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


class Chunk:
    """One row of the chunk table as arrays."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        self.id = batch.column("chunk")[i].as_py()
        self.rows = batch.column("rows")[i].values
        self.lengths = batch.column("lengths")[i].values
        self.offsets = np.zeros(len(self.lengths) + 1, np.int64)
        np.cumsum(self.lengths.fill_null(0).to_numpy(zero_copy_only=False), out=self.offsets[1:])
        self.data = unsqueeze(batch.column("text")[i])

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def texts(self) -> pa.Array:
        """The texts as they came, null where they were null."""
        whole = binary_array(self.data, self.offsets).cast(pa.large_string())
        return pa.compute.if_else(self.lengths.is_valid(), whole, None)

    def keys(self, name: str) -> np.ndarray:
        """An integer column; null counts as the smallest value."""
        column = self.rows.field(name).cast(pa.int64())
        return column.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, pa.RecordBatch, int]]:
    for batch in batches:
        for i in range(len(batch)):
            yield Chunk(batch, i), batch, i
        k.release_memory()


def chunk_schema(chunks: DataFrame) -> list[T.StructField]:
    """The fields of the documents' other columns."""
    return chunks.schema["rows"].dataType.elementType.fields


def unpack(chunks: DataFrame, process: Callable, added: list[T.StructField]) -> DataFrame:
    """Back to one row per document: its other columns, then what ``process`` adds.

    ``process(chunk, batch, i)`` gives an array for each added column.
    """
    fields = [*chunk_schema(chunks), *added]
    names = [f"c{j}" for j in range(len(fields))]
    out = arrow_schema([T.StructField(n, f.dataType) for n, f in zip(names, fields)])
    step = 2000

    def run(batches):
        for chunk, batch, i in each(batches):
            columns = [*chunk.rows.flatten(), *process(chunk, batch, i)]
            columns = [c if c.type == f.type else c.cast(f.type) for c, f in zip(columns, out)]
            whole = pa.RecordBatch.from_arrays(columns, schema=out)
            for at in range(0, len(whole), step):
                yield whole.slice(at, step)

    done = chunks.mapInArrow(run, T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields)]))
    return done.toDF(*[f.name for f in fields])


def cut(buckets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that brings values together by bucket, and where each bucket begins."""
    kind = np.uint16 if n <= 1 << 16 else np.int64
    order = np.argsort(buckets.astype(kind), kind="stable")
    return order, np.searchsorted(buckets[order], np.arange(n + 1))


def distinct_in_buckets(values: np.ndarray, at: np.ndarray, buckets: int, kind):
    """The order of values by bucket and size; in that order, the distinct ones, their buckets and how often each comes."""
    values = values.astype(kind)
    order = np.argsort(values)
    for digit in range(0, max(1, (buckets - 1).bit_length()), 16):
        order = order[np.argsort((at[order] >> digit).astype(np.uint16), kind="stable")]
    values, at = values[order], at[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (at[1:] != at[:-1])
    return order, values[new], at[new], np.diff(np.flatnonzero(new), append=len(values))


def slices(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The bytes of the values between neighbouring bounds."""
    return binary_array(values.view(np.uint8), bounds * values.itemsize).cast(pa.binary())


def joined(column, kind) -> tuple[np.ndarray, np.ndarray]:
    """The values in all ``slices`` of a column, and where each slice begins and ends."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    data, bounds = k.flatten(column)
    return np.ascontiguousarray(data).view(kind), bounds // np.dtype(kind).itemsize


def packed_bits(bits: np.ndarray, bounds: np.ndarray, take: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    """Of the slices to take, the bits of each, from a byte of its own on; null where not valid."""
    firsts, sizes = bounds[:-1][take], np.diff(bounds)[take]
    ends = np.concatenate([[0], np.cumsum((sizes + 7) // 8)])
    spread = np.zeros(8 * ends[-1], bool)
    spread[k.ranges(8 * ends[:-1], sizes)] = bits[k.ranges(firsts, sizes)]
    out = slices(np.packbits(spread), ends)
    return out if valid is None else pa.compute.if_else(pa.array(valid[take]), out, None)


def repeated(chunks: DataFrame, hashes: Callable, buckets: int, kind=np.uint64, crowd: int | None = None) -> DataFrame:
    """``(chunk, marks)``: which distinct hashes of each chunk stand in another chunk too.

    ``hashes(chunk)`` gives the hashes and the bucket of each. A chunk sends each of its hashes
    once, as one block of sorted hashes per bucket; a bucket counts the hashes of all chunks and
    answers each block with a bit per hash. So one hash that stands everywhere costs a bucket at
    most one value per chunk. With ``crowd`` a second bit tells which of them stand that often
    or more in all chunks together.
    """

    def send(batches):
        for chunk, _, _ in each(batches):
            _, values, at, n = distinct_in_buckets(*hashes(chunk), buckets, kind)
            heads = np.flatnonzero(np.diff(at, prepend=-1))
            ends = np.append(heads, len(values))
            columns = [
                pa.array(at[heads], pa.int32()),
                pa.array(np.full(len(heads), chunk.id), pa.int64()),
                slices(values, ends),
                slices(n.clip(max=65535).astype(np.uint16), ends if crowd is not None else np.zeros_like(ends)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "chunk", "hashes", "counts"])

    def count(table: pa.Table) -> pa.Table:
        values, bounds = joined(table.column("hashes"), kind)
        again = k.twice_sorted(np.sort(values))
        own = k.in_sorted(values, again)
        some = k.sums_between(own, bounds) > 0
        out = table.select(["chunk", "bucket"]).filter(pa.array(some)).append_column("bits", packed_bits(own, bounds, some))
        crowded = pa.nulls(len(out), pa.binary())
        if crowd is not None:
            n = joined(table.column("counts"), np.uint16)[0]
            total = np.bincount(np.searchsorted(again, values[own]), n[own], len(again))
            many = k.in_sorted(values, again[total >= crowd])
            if many.any():
                crowded = packed_bits(many, bounds, some, k.sums_between(many, bounds) > 0)
        k.release_memory()
        return out.append_column("crowded", crowded)

    blocks = chunks.mapInArrow(send, "bucket int, chunk long, hashes binary, counts binary")
    answers = blocks.groupBy("bucket").applyInArrow(count, "chunk long, bucket int, bits binary, crowded binary")
    answers = stage(answers, "repeated", small=True).groupBy("chunk")
    return answers.agg(F.collect_list(F.struct("bucket", "bits", "crowded")).alias("marks"))


def with_marks(chunks: DataFrame, marks: DataFrame) -> DataFrame:
    return chunks.join(marks, "chunk", "left")


def is_repeated(values: np.ndarray, at: np.ndarray, buckets: int, marks, kind=np.uint64) -> np.ndarray:
    """Which hashes of a chunk stand twice or more, in the chunk itself or by its marks."""
    return _marked(values, at, buckets, marks, kind, "bits", True)


def is_crowded(values: np.ndarray, at: np.ndarray, buckets: int, marks, kind=np.uint64) -> np.ndarray:
    """Which hashes of a chunk make a crowd by its marks."""
    return _marked(values, at, buckets, marks, kind, "crowded", False)


def _marked(values, at, buckets, marks, kind, field: str, also_own: bool) -> np.ndarray:
    if not also_own and not (marks is not None and marks.is_valid and marks.values.field(field).null_count < len(marks.values)):
        return np.zeros(len(values), bool)
    order, once, bucket, n = distinct_in_buckets(values, at, buckets, kind)
    found = n > 1 if also_own else np.zeros(len(once), bool)
    if marks is not None and marks.is_valid:
        answers = marks.values.filter(marks.values.field(field).is_valid())
        asked = answers.field("bucket").to_numpy().astype(bucket.dtype)
        first = np.searchsorted(bucket, asked)
        sizes = np.searchsorted(bucket, asked, "right") - first
        data, bounds = joined(answers.field(field), np.uint8)
        found[k.ranges(first, sizes)] |= np.unpackbits(data).astype(bool)[k.ranges(bounds[:-1] * 8, sizes)]
    out = np.empty(len(order), bool)
    out[order] = np.repeat(found, n)
    return out
