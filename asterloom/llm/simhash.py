"""SimHash near-duplicates: 64-bit fingerprints of word shingles, compared exactly in tiles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm import kernels as k
from asterloom.llm.chunks import arrow_schema, by_position, stage
from asterloom.llm.components import components

SHINGLE_WORDS = 3
RADIUS = 2
SEED = 42
#: Fingerprints of a tile, about.
TILE = 2048
#: Shingle hashes whose bits are held at a time.
HASHES = 1 << 16


def shingle_hashes(text: bytes, words: int) -> list[int]:
    """XXH64 of each run of words, lower-cased and joined by one space."""
    parts = text.lower().split()
    if not parts:
        return []
    whole = b" ".join(parts)
    if len(parts) <= words:
        return [xxhash.xxh64_intdigest(whole, SEED)]
    space = np.flatnonzero(np.frombuffer(whole, np.uint8) == 0x20)
    starts = [0, *(space + 1).tolist()]
    ends = [*space.tolist(), len(whole)]
    digest = xxhash.xxh64_intdigest
    return [digest(whole[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])]


def majority(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text the bits that over half of its hashes have; zero for texts without any."""
    counts = np.diff(bounds)
    ones = np.zeros((len(counts), 64), np.int64)
    for at in range(0, len(hashes), HASHES):
        part = slice(at, min(at + HASHES, len(hashes)))
        bits = np.unpackbits(hashes[part].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        own = np.clip(bounds, part.start, part.stop) - part.start
        some = np.flatnonzero(own[1:] > own[:-1])
        ones[some] += np.add.reduceat(bits, own[some], axis=0, dtype=np.int32)
    return np.packbits(2 * ones > counts[:, None], axis=1).view(">u8").astype(k.U).ravel()


def fingerprints(docs: DataFrame, text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """The documents with ``fingerprint`` (the 64 bits as a long) in place of the text."""
    frame, names = by_position(docs)
    here = names.index(text)
    keep = [j for j in range(len(names)) if j != here]
    fields = [*[frame.schema.fields[j] for j in keep], T.StructField("fingerprint", T.LongType())]
    out = arrow_schema(fields)

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 64):
                batch = whole.slice(at, 64)
                hashes, counts = [], [0]
                for value in batch.column(here):
                    own = shingle_hashes(value.as_buffer().to_pybytes(), words) if value.is_valid else []
                    hashes.append(np.array(own, k.U))
                    counts.append(len(own))
                found = majority(np.concatenate(hashes), np.cumsum(counts)).view(np.int64)
                yield pa.RecordBatch.from_arrays([*[batch.column(j) for j in keep], pa.array(found)], schema=out)

    return frame.mapInArrow(run, T.StructType(fields)).toDF(*[names[j] for j in keep], "fingerprint")


def _populations(fingerprint: Column, blocks: int) -> list[Column]:
    size = 64 // blocks
    mask = (1 << size) - 1
    return [F.bit_count(F.shiftrightunsigned(fingerprint, size * j).bitwiseAND(F.lit(mask))) for j in range(blocks)]


def _steps(blocks: int, radius: int) -> list[list[int]]:
    """Changes of the block populations that a radius allows, one of each pair of opposites."""
    found = [()]
    for _ in range(blocks):
        found = [(*x, d) for x in found for d in range(-radius, radius + 1) if sum(map(abs, x)) + abs(d) <= radius]
    return [list(x) for x in found if x >= (0,) * blocks]


class Forest:
    """Joins links to trees, so that only links that connect something go on."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while (up := parent.setdefault(top, top)) != top:
            top = up
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = 4, tile: int = TILE) -> DataFrame:
    """``(a, b)``: links between ``fingerprint`` values that differ in at most ``radius`` bits.

    The fingerprints lie in tiles by the population counts of their ``blocks`` blocks of bits. A
    differing bit changes one of the counts by one, so tiles whose counts differ by more than the
    radius in all cannot hold a pair and are never brought together; the others are compared
    whole, by exclusive-or and bit counts. Tiles with too many fingerprints are split, and every
    pair of parts is compared. Of the links in a task, those are left out that join what others
    of the same task have joined.
    """
    counted = distinct.select("fingerprint", F.array(*_populations(F.col("fingerprint"), blocks)).alias("populations"))
    sizes = counted.groupBy("populations").agg((F.floor(F.count(F.lit(1)) / tile) + 1).alias("parts"))
    # At most (64 / blocks + 1) ** blocks rows, 83,521 with four blocks.
    counted = counted.join(F.broadcast(sizes), "populations")
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts"))
    tiles = counted.groupBy("populations", part.alias("part")).agg(F.collect_list("fingerprint").alias("prints"))
    tiles = stage(tiles, "tiles")
    steps = F.array(*[F.array(*[F.lit(d) for d in s]) for s in _steps(blocks, radius)])
    other = tiles.select(F.explode(steps).alias("step"), "populations", F.col("part").alias("other_part"), F.col("prints").alias("other"))
    met = F.zip_with("populations", "step", lambda p, d: (p + d).cast("int")).alias("populations")
    same = F.aggregate("step", F.lit(0), lambda s, d: s + F.abs(d)) == 0
    other = other.select(met, same.alias("same"), "other_part", "other").join(F.broadcast(sizes), "populations")
    # Each pair of parts is a row with a key of its own, so that the parts of a full tile are compared by many tasks.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    other = other.select("populations", "same", "other_part", "other", part)
    other = other.filter(~F.col("same") | (F.col("part") <= F.col("other_part")))
    pairs = tiles.join(other, ["populations", "part"])

    def compare(batches):
        forest, found = Forest(), []
        for batch in batches:
            for left, right in zip(batch.column("prints"), batch.column("other")):
                a = left.values.to_numpy().view(k.U)
                b = right.values.to_numpy().view(k.U)
                for at in range(0, len(a), 256):
                    x, y = np.nonzero(np.bitwise_count(a[at : at + 256, None] ^ b[None, :]) <= radius)
                    apart = a[at + x] != b[y]
                    for p, q in zip(a[at + x[apart]].view(np.int64).tolist(), b[y[apart]].view(np.int64).tolist()):
                        if forest.join(p, q):
                            found.append((p, q))
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found)]
                found = []
                yield pa.RecordBatch.from_arrays(columns, ["a", "b"])

    return pairs.select("prints", "other").mapInArrow(compare, "a long, b long")


def _grouped(frame: DataFrame, key: str, text: str, words: int, radius: int) -> DataFrame:
    """The frame without text, with ``fingerprint``, ``root`` (a fingerprint, for each component) and ``component_id``."""
    prints = stage(fingerprints(frame, text, words), "fingerprints")
    distinct = stage(prints.groupBy("fingerprint").agg(F.min(key).alias("least")), "distinct")
    found = stage(components(stage(links(distinct, radius), "links")), "components")
    roots = distinct.join(found, distinct.fingerprint == found.node, "left")
    roots = roots.select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    group = stage(roots.join(smallest, "root").select("fingerprint", "root", "component_id"), "groups")
    return prints.join(group, "fingerprint")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS
) -> DataFrame:
    """The documents with ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    A-Z are lower-cased; words are runs of characters other than space and 09 to 0D; shingles are
    ``words`` words (or all, if fewer), hashed by XXH64 with seed 42. A fingerprint bit is 1 if
    over half of the shingles have it. Null, empty and blank texts have fingerprint zero and are
    linked like others. Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest key that links lead to (null only where all keys are null).
    Equal fingerprints count once, however many documents have them. Repeated rows stay; an empty
    table gives an empty table. The text column is not part of the result.
    """
    frame, names = by_position(docs)
    keep = [j for j, n in enumerate(names) if n != text]
    out = _grouped(frame, f"c{names.index(key)}", f"c{names.index(text)}", words, radius)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint")
    out = out.select(*[f"c{j}" for j in keep], digits, "component_id")
    return out.toDF(*[names[j] for j in keep], "fingerprint", "component_id")


def first_of_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One document of each component of ``near_duplicates``: that with the smallest key.

    Null keys come last, and ties are broken by fingerprint and a hash of the text; of repeated
    rows one stays. The columns are those of the input. The choice is made without the texts,
    which are then shuffled once; a component costs each task one row, however large it is.
    """
    frame, names = by_position(docs)
    k_, t_ = f"c{names.index(key)}", f"c{names.index(text)}"
    same_key = F.coalesce(F.col(k_).cast("string"), F.lit("")).alias("same_key")
    marked = frame.select("*", same_key, F.xxhash64(t_).alias("same_text"))
    grouped = _grouped(marked.select(k_, t_, "same_key", "same_text"), k_, t_, words, radius)
    row = F.struct(F.col(k_).isNull().alias("none"), F.col(k_).alias("key"), "fingerprint", "same_text", "same_key")
    first = grouped.groupBy("root").agg(F.min(row).alias("row")).select("row.same_key", "row.same_text")
    kept = marked.join(stage(first, "first"), ["same_key", "same_text"], "left_semi")
    place = F.row_number().over(Window.partitionBy("same_key", "same_text").orderBy(F.lit(0)))
    kept = kept.withColumn("place", place).filter("place = 1")
    return kept.select(*frame.columns).toDF(*names)
