"""Quartile bucket digests of documents, and how alike two of them are.

Hashed byte triplets are counted in buckets; a digest keeps for each bucket in which quarter of
the counts it lies, next to the length. Small edits move few buckets over a quartile, so the
difference of two digests grows with what was changed.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm import kernels as k
from asterloom.llm.chunks import arrow_schema, by_position, stage, text_bytes

BUCKETS = 128
#: Places of a triplet in a window of five bytes, besides the first byte.
TRIPLETS = ((1, 2), (1, 3), (2, 3), (2, 4))
#: Difference of two digests at which nothing is alike: each bucket adds at most 6.
MOST = 240
#: Difference for each step of the logarithmic length, and its bound.
LENGTH_STEP, LENGTH_MOST = 4, 60
BYTES_AT_ONCE = 1 << 18


def triplet_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text the triplets in each bucket. No triplet crosses texts."""
    n = len(offsets) - 1
    counts = np.zeros((n, BUCKETS), np.int64)
    owner = np.repeat(np.arange(n) * BUCKETS, np.diff(offsets))
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    first = data.astype(np.uint32)
    for kind, (a, b) in enumerate(TRIPLETS):
        m = len(data) - b
        if m <= 0:
            continue
        h = first[:m] * np.uint32(0x9E3779B1) + first[a : a + m] * np.uint32(0x85EBCA77) + first[b:] * np.uint32(0xC2B2AE3D)
        h += np.uint32((kind * 0x27D4EB2F) & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        bucket = (h >> np.uint32(25)).astype(np.int64)
        whole = left[:m] > b
        counts += np.bincount((owner[:m] + bucket)[whole], minlength=n * BUCKETS).reshape(n, BUCKETS)
    return counts


def encode(counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A digest per text, as bytes: the length on a logarithmic scale, then two bits per bucket.

    A bucket's bits tell how many of the three quartiles of the counts it exceeds. Texts of fewer
    than three bytes have all buckets at zero.
    """
    ordered = np.sort(counts, axis=1)
    quartiles = ordered[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    code = (counts[:, :, None] > quartiles[:, None, :]).sum(axis=2)
    bits = np.stack([code >> 1, code & 1], axis=2).reshape(len(counts), -1).astype(np.uint8)
    size = np.floor(np.log(np.maximum(lengths, 1)) / np.log(1.1)).clip(0, 255).astype(np.uint8)
    return np.concatenate([size[:, None], np.packbits(bits, axis=1)], axis=1)


def digests(texts: pa.Array) -> np.ndarray:
    data, offsets = k.flatten(texts)
    out, at = np.zeros((len(texts), 1 + BUCKETS // 4), np.uint8), 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BYTES_AT_ONCE, "right")) - 1)
        to = min(to, len(texts), at + 256)
        own = offsets[at : to + 1]
        counts = triplet_counts(data[own[0] : own[-1]], own - own[0])
        out[at:to] = encode(counts, np.diff(own))
        at = to
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From 1 for equal digests to 0 for those that differ by ``MOST`` or more.

    A bucket adds the steps between its quarters, and 6 for three; lengths add by their ratio.
    """
    codes = [np.unpackbits(x[:, 1:], axis=1).reshape(len(x), BUCKETS, 2).astype(np.int8) @ np.array([2, 1], np.int8) for x in (a, b)]
    steps = np.abs(codes[0] - codes[1]).astype(np.int64)
    buckets = np.where(steps == 3, 6, steps).sum(axis=1)
    length = np.abs(a[:, 0].astype(np.int64) - b[:, 0]) * LENGTH_STEP
    return 1 - np.minimum(buckets + np.minimum(length, LENGTH_MOST), MOST) / MOST


def to_hex(rows: np.ndarray) -> pa.Array:
    return pa.array([x.tobytes().hex() for x in rows], pa.string())


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with a last column ``fingerprint`` (hexadecimal).

    Null texts count as empty; equal texts have equal fingerprints; repeated rows stay; an empty
    table gives an empty table.
    """
    frame, names = by_position(docs)
    here = names.index(text)
    fields = [*frame.schema.fields, T.StructField("fingerprint", T.StringType())]
    out = arrow_schema(fields)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, to_hex(digests(batch.column(here)))], schema=out)

    return frame.mapInArrow(run, T.StructType(fields)).toDF(*names, "fingerprint")


def compare(pairs: DataFrame, a: str, b: str, name: str = "likeness") -> DataFrame:
    """The rows with a last column: how alike two fingerprint columns are, null if one is null."""
    fields = [*pairs.schema.fields, T.StructField(name, T.DoubleType())]
    frame, names = by_position(pairs)
    left, right = names.index(a), names.index(b)
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    out = arrow_schema(schema.fields)

    def run(batches):
        for batch in batches:
            found = np.full(len(batch), np.nan)
            both = [i for i in range(len(batch)) if batch.column(left)[i].is_valid and batch.column(right)[i].is_valid]
            if both:
                x, y = (np.frombuffer(bytes.fromhex("".join(batch.column(c)[i].as_py() for i in both)), np.uint8).reshape(len(both), -1) for c in (left, right))
                found[both] = likeness(x, y)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, from_pandas=True)], schema=out)

    return frame.mapInArrow(run, schema).toDF(*names, name)


#: Quantiles of the keys that bound the blocks; between them blocks are of equal key ranges.
QUANTILES = 500
#: Blocks that a task has, about, at most.
TASK_BLOCKS = 4


def _block(key: Column, bounds: list[int], parts: int) -> Column:
    """A number that ascends with the key: the bounds up to it, then its place between two bounds.

    Null comes first.
    """

    def count(low, high):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < bounds[middle], count(low, middle)).otherwise(count(middle + 1, high))

    place = count(0, len(bounds))
    if parts > 1:
        edges = F.array(*[F.lit(float(x)) for x in bounds])
        low = F.get(edges, place - 1)
        share = (key.cast("double") - low) / (F.get(edges, place) - low)
        inner = F.least(F.floor(share * parts), F.lit(parts - 1))
        place = place * parts + F.coalesce(inner, F.lit(0))
    return F.when(key.isNull(), 0).otherwise(place).cast("long")


def in_blocks(docs: DataFrame, key: str, text: str, blocks: int) -> DataFrame:
    """``(block, guest, key, text)``: documents in blocks of neighbouring keys, sorted in each.

    The first document of each block also stands, as a guest, at the end of the block before (of
    the last block, for the first one), so that a task sees the document after its last one.
    Approximate quantiles bound the blocks, which only sets their sizes.
    """
    frame = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    n = min(blocks, QUANTILES)
    found = frame.approxQuantile("key", [j / n for j in range(n + 1)], 0.1 / n)
    placed = frame.withColumn("block", _block(F.col("key"), sorted({int(x) for x in found}), -(-blocks // n)))
    # Null keys first, then by key and text: the least of these structs is a block's first row.
    row = F.struct(F.col("key").isNotNull().alias("some"), "key", F.coalesce("text", F.lit("")).alias("text"))
    heads = placed.groupBy("block").agg(F.min(row).alias("row")).select("block", "row.key", "row.text")
    heads = stage(heads, "heads")
    # One row per block.
    order = Window.orderBy("block")
    ends = heads.select("block", F.lag("block").over(order).alias("before"), F.max("block").over(Window.partitionBy()).alias("last"))
    guests = heads.join(ends, "block").select(F.coalesce("before", "last").alias("block"), F.lit(True).alias("guest"), "key", "text")
    whole = placed.select("block", F.lit(False).alias("guest"), "key", "text").unionByName(guests)
    # A few blocks a task, however many there are.
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-blocks // TASK_BLOCKS))
    some, text_or_empty = F.col("key").isNotNull(), F.coalesce("text", F.lit(""))
    return whole.repartition(n, "block").sortWithinPartitions("block", "guest", some, "key", text_or_empty)


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", block_bytes: int = 4 << 20) -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    The next document is the one after in ascending order of key (null first) and text, after the
    last one the first; a single document is its own next one. The edited text has its last
    ``floor(n_chars / 2)`` code points replaced by the first as many, or all, of the next text.
    Returns the key, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited`` and ``near_next``: the likeness of the fingerprint to
    those of the edited and the next text. Null texts count as empty; repeated rows stay, each
    the next one of the other; an empty table gives an empty table.
    """
    blocks = max(48, text_bytes(docs, text) // block_bytes + 1)
    out = pa.schema(
        [
            ("key", pa.int64()),
            ("n_chars", pa.int64()),
            ("edited_sha256", pa.string()),
            ("fingerprint", pa.string()),
            ("edited_fingerprint", pa.string()),
            ("near_edited", pa.float64()),
            ("near_next", pa.float64()),
        ]
    )

    def run(batches):
        held = None
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = pa.Table.from_batches([whole.slice(at, 500)])
                batch = batch.append_column("digest", pa.array([x.tobytes() for x in digests(batch.column("text"))], pa.binary()))
                batch = batch if held is None else pa.concat_tables([held, batch])
                held = batch.slice(len(batch) - 1)
                block = batch.column("block").to_numpy()
                guest = batch.column("guest").to_numpy()
                at_own = np.flatnonzero((block[1:] == block[:-1]) & ~guest[:-1])
                if len(at_own) == 0:
                    continue
                texts = batch.column("text").fill_null("").to_pylist()
                digest = np.frombuffer(b"".join(batch.column("digest").to_pylist()), np.uint8).reshape(len(batch), -1)
                edited = []
                for i in at_own.tolist():
                    n = len(texts[i])
                    edited.append((texts[i][: n - n // 2] + texts[i + 1][: n // 2]).encode())
                mine, other = digest[at_own], digests(pa.array(edited, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key").take(pa.array(at_own)).combine_chunks(),
                        pa.array([len(texts[i]) for i in at_own.tolist()], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in edited], pa.string()),
                        to_hex(mine),
                        to_hex(other),
                        pa.array(likeness(mine, other)),
                        pa.array(likeness(mine, digest[at_own + 1])),
                    ],
                    schema=out,
                )

    schema = "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return in_blocks(docs, key, text, blocks).mapInArrow(run, schema).withColumnRenamed("key", key)
