"""Nearest neighbours by cosine with an inverted multi-index.

The two halves of the unit vectors are quantised separately, so K centroids a half make K * K
cells. A query walks through pairs of centroids in ascending order of their summed distances, by a
heap, until the cells passed hold a learned share of all entries; the entries of these cells are
ranked again by their exact cosines. Where the walk would be long, the same cells are selected at once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm import kernels as k
from asterloom.llm.chunks import stage

#: Vectors, about, that the centroids and the share of entries to pass are learned from, drawn by hash.
SAMPLE_VECTORS = 20_000
#: Queries of the sample that the share is measured with.
SAMPLE_QUERIES = 300
#: Share of the sample's true neighbours that must lie in the cells passed.
RECALL = 0.95
#: Entries of a cell, about, that set the number of centroids a half, up to the most there may be.
CELL_ENTRIES, CENTROIDS = 16, 256
ITERATIONS = 12
#: Entries of a block; a cell with more is cut into parts by a hash of the vector.
BLOCK_ENTRIES = 4096
#: Bytes of the vectors that one task holds, of neighbouring blocks, and the number of such groups that small tables are cut into, too.
GROUP_BYTES, LEAST_GROUPS = 96 << 20, 24
#: Bytes of vectors in a row at most, about.
ROW_BYTES = 4 << 20
#: Queries that travel together.
QUERY_BATCH = 4096
#: Pairs of a query and an entry that are compared at a time, about.
COMPARED = 1 << 19
#: Entries of neighbouring cells that are compared at a time: at least and at most.
LEAST_STRIP, STRIP = 128, 1024
#: Candidates a query, of all queries of a batch, that are held before only the best are kept.
POOL = 32
#: Cells, about, up to which a walk is made by the heap.
WALK_CELLS = 256
#: Ranges of the summed distances that a selection counts the entries of.
RANGES = 4096
#: Entries passed at least.
LEAST_ENTRIES = 1000


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Rows in double precision, each times a power of two, so that squares neither overflow nor vanish."""
    vectors = vectors.astype(np.float64)
    if vectors.size == 0:
        return vectors
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def norms(vectors: np.ndarray) -> np.ndarray:
    return np.sqrt((vectors * vectors).sum(axis=1))


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / norms(vectors)[:, None] if len(vectors) else vectors


def distances(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all points to all centroids."""
    found = (points * points).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1) - 2 * points @ centroids.T
    return np.maximum(found, 0)


def k_means(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Lloyd's iteration from distinct points drawn by the seed."""
    points = np.unique(points, axis=0)
    k = max(1, min(k, len(points)))
    centroids = points[np.random.default_rng(seed).choice(len(points), k, replace=False)]
    for _ in range(ITERATIONS):
        own = distances(points, centroids).argmin(axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, own, points)
        count = np.bincount(own, minlength=k)[:, None]
        centroids = np.where(count > 0, total / np.maximum(count, 1), centroids)
    return centroids


def walk(first: np.ndarray, second: np.ndarray, sizes: list[list[int]], wanted: int) -> list[int]:
    """Cells in ascending order of their summed distances, until they hold the wanted entries.

    ``sizes`` are the entries by centroid of the first and of the second half. A pair of ranks enters the heap once both pairs before it, in either half, have left it.
    """
    rows, columns = np.argsort(first, kind="stable").tolist(), np.argsort(second, kind="stable").tolist()
    a, b = np.sort(first).tolist(), np.sort(second).tolist()
    width = len(b)
    done = [0] * len(a)  # how many ranks of the second half each rank of the first has passed
    heap, out, held = [(a[0] + b[0], 0, 0)], [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        done[i] = j + 1
        size = sizes[rows[i]][columns[j]]
        if size:
            out.append(rows[i] * width + columns[j])
            held += size
        if i + 1 < len(a) and done[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
        if j + 1 < width and (i == 0 or done[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
    return out


def select(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> np.ndarray:
    """Which cells ``walk`` gives, equal sums included, without a step for each.

    The entries are counted by ranges of the summed distances; only the range in which the walk ends is sorted.
    """
    sums = (first[:, None] + second).ravel()
    low, high = sums.min(), sums.max()
    at = ((sums - low) * (RANGES / (high - low) if high > low else 0)).astype(np.intp)
    held = np.cumsum(np.bincount(at, sizes, RANGES + 1))
    last = int(np.searchsorted(held, wanted))
    passed = (at < last) & (sizes > 0)
    if last < len(held):
        rest = np.flatnonzero(at == last)
        rest = rest[sizes[rest] > 0]
        rows, columns = np.argsort(first, kind="stable").argsort(), np.argsort(second, kind="stable").argsort()
        i, j = rest // len(second), rest % len(second)
        rest = rest[np.lexsort((columns[j], rows[i], sums[rest]))]
        before = (held[last - 1] if last else 0) + np.cumsum(sizes[rest]) - sizes[rest]
        passed[rest[before < wanted]] = True
    return passed


@dataclass(frozen=True)
class Index:
    """The centroids of both halves, and the share of all entries that a query passes."""

    first: np.ndarray
    second: np.ndarray
    share: float = 1.0

    @property
    def cells(self) -> int:
        return len(self.first) * len(self.second)

    def to_centroids(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = self.first.shape[1]
        return distances(units[:, :half], self.first), distances(units[:, half:], self.second)

    def cell(self, units: np.ndarray) -> np.ndarray:
        a, b = self.to_centroids(units)
        return a.argmin(axis=1) * len(self.second) + b.argmin(axis=1)


def fit(vectors: np.ndarray, centroids: int, neighbours: int, recall: float = RECALL) -> Index:
    """An index learned from a sample: centroids by k-means, the share by its own neighbours.

    The share is the least one at which the cells passed hold the ``recall`` part of the exact neighbours
    of some of the sample's vectors among all of it.
    """
    units = unit(vectors)
    half = units.shape[1] // 2
    index = Index(k_means(units[:, :half], centroids, 1), k_means(units[:, half:], centroids, 2))
    n = len(units)
    if n < 2:
        return index
    cell = index.cell(units)
    size = np.bincount(cell, minlength=index.cells)
    queries = np.unique(np.linspace(0, n - 1, min(n, SAMPLE_QUERIES)).astype(int))
    needed = []
    for at in queries:
        near = units @ units[at]
        near[at] = -np.inf
        best = np.argsort(-near, kind="stable")[: min(neighbours, n - 1)]
        a, b = index.to_centroids(units[at : at + 1])
        order = np.argsort((a[0][:, None] + b[0]).ravel(), kind="stable")
        passed = np.empty(index.cells)
        passed[order] = np.cumsum(size[order])
        needed.append(passed[cell[best]] / n)
    return Index(index.first, index.second, float(np.quantile(np.concatenate(needed), recall)))


@dataclass(frozen=True)
class Blocks:
    """Which block the entries of each cell are in: small cells share one, large ones have several."""

    sizes: np.ndarray
    first: np.ndarray
    parts: np.ndarray

    @classmethod
    def of(cls, sizes: np.ndarray, entries: int = BLOCK_ENTRIES) -> Blocks:
        parts = np.maximum(1, -(-sizes // entries))
        first = np.zeros(len(sizes), np.int64)
        block, held = 0, 0
        for cell, (size, n) in enumerate(zip(sizes.tolist(), parts.tolist())):
            if held and (n > 1 or held + size > entries):
                block, held = block + 1, 0
            first[cell] = block
            held += size
            if n > 1:
                block, held = block + n, 0
        return cls(sizes, first, parts)

    def cells_by_block(self) -> dict[int, np.ndarray]:
        """The cells with entries of each block, in order."""
        out: dict[int, list[int]] = {}
        for cell in np.flatnonzero(self.sizes):
            for part in range(self.parts[cell]):
                out.setdefault(int(self.first[cell]) + part, []).append(int(cell))
        return {b: np.array(c) for b, c in out.items()}

    def groups(self, entries: int) -> np.ndarray:
        """The group of each block: neighbouring blocks that hold about ``entries``, numbered from 0."""
        held = np.zeros(int((self.first + self.parts).max()))
        where = np.repeat(self.first, self.parts) + k.ranges(np.zeros_like(self.parts), self.parts)
        np.add.at(held, where, np.repeat(self.sizes / self.parts, self.parts))
        ends = np.cumsum(held)
        return np.unique(((ends - held / 2) // entries).astype(np.int64), return_inverse=True)[1]

    def cells_by_group(self, group: np.ndarray) -> dict[int, np.ndarray]:
        """The cells with entries of each group, in order."""
        out: dict[int, list[np.ndarray]] = {}
        for block, cells in self.cells_by_block().items():
            out.setdefault(int(group[block]), []).append(cells)
        return {g: np.unique(np.concatenate(c)) for g, c in out.items()}


class Group:
    """The entries of neighbouring blocks in order of their cells, and the strips that are compared at a time.

    Rows of entries are added as they come, with the cell, the number of keys and the keys of each; ``close``
    puts them in order. Room that is not used takes no memory. A strip has its first and last entry and its
    first and last cell among ``cells``.
    """

    def __init__(self, cells: np.ndarray, dtype: np.dtype, width: int, room: int):
        self.cells, self.vectors, self.n, self.pieces = cells, np.empty((room, width), dtype), 0, []

    def add(self, vectors: np.ndarray, cell: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        end = self.n + len(vectors)
        if end > len(self.vectors):
            more = np.empty((2 * end, vectors.shape[1]), vectors.dtype)
            more[: self.n] = self.vectors[: self.n]
            self.vectors = more
        self.vectors[self.n : end] = vectors
        self.n = end
        self.pieces.append((np.searchsorted(self.cells, cell), counts.astype(np.int64), ids.copy()))

    def close(self) -> Group:
        where, counts, self.ids = map(np.concatenate, zip(*self.pieces))
        self.pieces = []
        #: The rows of the vectors in order of their cells; all that follows is in this order.
        self.order = order = np.argsort(where, kind="stable")
        starts = np.cumsum(counts) - counts
        self.where, self.counts, self.starts = where[order], counts[order], starts[order]
        #: Which entries have a key that others have, too.
        _, key, times = np.unique(self.ids, return_inverse=True, return_counts=True)
        self.shared = np.logical_or.reduceat(times[key] > 1, starts)[order]
        width = self.vectors.shape[1]
        self.units, self.lengths = np.empty((self.n, width), np.float32), np.empty(self.n)
        for at in range(0, self.n, 4096):
            exact = scaled(self.vectors[order[at : at + 4096]])
            self.lengths[at : at + 4096] = length = norms(exact)
            self.units[at : at + 4096] = exact / length[:, None]
        #: Twice what the approximate score of single precision is off at most, in sums of any order.
        self.slack = (width + 16) * 2.0**-23
        self.strips = list(self._strips())
        return self

    def _strips(self) -> Iterator[tuple[int, int, int, int]]:
        ends = np.append(np.flatnonzero(np.diff(self.where)) + 1, len(self.where)).tolist()
        first = 0
        for at, end in enumerate(ends):
            if end - first >= LEAST_STRIP or at + 1 == len(ends) or ends[at + 1] - first > STRIP:
                for start in range(first, end, STRIP):
                    stop = min(end, start + STRIP)
                    yield start, stop, int(self.where[start]), int(self.where[stop - 1]) + 1
                first = end


def true_at(hits: np.ndarray) -> np.ndarray:
    """The positions of the few true values, eight looked at together."""
    flat = hits.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64) != 0)
    at = (words[:, None] * 8 + np.arange(8)).ravel()
    at = np.concatenate([at, np.arange(whole, len(flat))])
    return at[flat[at]]


class Ranking:
    """The nearest entries of a group to each query of a batch, among the entries of the cells that it passes.

    Scores in single precision tell which entries can be among the ``n`` best; these are scored again, each in
    the same way wherever it stands, so that equal vectors have equal scores. ``least`` is the approximate
    score that an entry needs to be among the best, from what has been found so far. ``masks`` have a row of
    bits for each cell of the group: the queries that pass it.
    """

    def __init__(self, vectors: np.ndarray, own: np.ndarray, masks: np.ndarray, group: Group, n: int):
        self.mine, self.own, self.masks, self.group, self.n = scaled(vectors), own, masks, group, n
        self.lengths = norms(self.mine)
        self.units = (self.mine / self.lengths[:, None]).astype(np.float32)
        self.least = np.full(len(own), -np.inf, np.float32)
        self.best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        room = COMPARED + STRIP
        self.taken, self.near, self.hits = np.empty_like(self.units), np.empty(room, np.float32), np.empty(room, bool)

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, id, score)``, queries by their place in the batch: the n best of each, or all if there are fewer."""
        pool, held = [], 0
        for strip in self.group.strips:
            for found in self._compare(*strip):
                pool.append(found)
                held += len(found[0])
                if held > POOL * len(self.own):
                    self._keep(*map(np.concatenate, zip(*pool)))
                    pool, held = [], 0
        if pool:
            self._keep(*map(np.concatenate, zip(*pool)))
        return self.best

    def _compare(self, first: int, last: int, low: int, high: int):
        """The entries of a strip that can be among the best: query, entry and approximate score."""
        bits, one = self.masks[low:high], high - low == 1
        some = np.flatnonzero(np.unpackbits(bits[0] if one else np.bitwise_or.reduce(bits, axis=0), count=len(self.own)))
        if len(some) == 0:
            return
        passed = None if one else np.unpackbits(bits, axis=1, count=len(self.own)).astype(bool)
        entries, size = self.group.units[first:last], last - first
        parts = -(-len(some) * size // COMPARED)
        for rows in np.array_split(some, parts) if parts > 1 else [some]:
            # In memory that stays: entries down, queries across.
            n, shape = len(rows), (size, len(rows))
            units = np.take(self.units, rows, axis=0, out=self.taken[:n], mode="clip")
            near = np.matmul(entries, units.T, out=self.near[: size * n].reshape(shape))
            least = self.least[rows]
            new = np.flatnonzero(least == -np.inf)
            if len(new) and size > self.n + 1 and not self.group.shared[first:last].any():
                # Of n + 1 entries that no key shares, one has the query's own key at most.
                part = near.T[new]
                if not one:
                    part[~passed[:, rows[new]][self.group.where[first:last] - low].T] = -np.inf
                least[new] = np.partition(part, size - self.n - 1, axis=1)[:, size - self.n - 1] - 2 * self.group.slack
                self.least[rows[new]] = least[new]
            hits = true_at(np.greater_equal(near, least, out=self.hits[: size * n].reshape(shape)))
            if len(hits) == 0:
                continue
            entry, query = np.divmod(hits, n)
            score, query, entry = near.ravel()[hits], rows[query], entry + first
            if not one:
                right = passed[self.group.where[entry] - low, query]
                query, entry, score = query[right], entry[right], score[right]
            yield query, entry, score

    def _keep(self, query: np.ndarray, entry: np.ndarray, near: np.ndarray) -> None:
        """Score the entries that can be among the best exactly, and keep the best of them and of those before."""
        group, n = self.group, self.n
        can = near >= self.least[query]
        query, entry, near = query[can], entry[can], near[can]
        # By query, from the highest score on; of n + 1 entries that no key shares, one has the query's own key at most.
        alone = ~group.shared[entry]
        bits = near[alone].view(np.uint32)
        falling = np.where(bits >> 31, bits, ~bits & np.uint32(0x7FFFFFFF))
        order = np.argsort((query[alone].astype(np.uint64) << np.uint64(32)) | falling)
        count = np.bincount(query[alone], minlength=len(self.own))
        many = np.flatnonzero(count > n)
        cut = near[alone][order[(np.cumsum(count) - count)[many] + n]] - np.float32(2 * group.slack)
        self.least[many] = np.maximum(self.least[many], cut)
        can = near >= self.least[query]
        query, entry = query[can], entry[can]
        exact = np.empty(len(query))
        for at in range(0, len(query), 4096):
            q, e = query[at : at + 4096], entry[at : at + 4096]
            exact[at : at + 4096] = (scaled(group.vectors[group.order[e]]) * self.mine[q]).sum(axis=1) / (group.lengths[e] * self.lengths[q])
        count = group.counts[entry]
        ids = group.ids[k.ranges(group.starts[entry], count)]
        query, score = np.repeat(query, count), np.repeat(exact, count)
        other = ids != self.own[query]
        query, ids, score = (np.concatenate(x) for x in zip(self.best, (query[other], ids[other], score[other])))
        if group.shared.any():
            order = np.lexsort((-score, ids, query))
            query, ids, score = query[order], ids[order], score[order]
            first = np.ones(len(query), bool)
            first[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
            query, ids, score = query[first], ids[first], score[first]
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        count = np.bincount(query, minlength=len(self.own))
        firsts = np.cumsum(count) - count
        best = np.arange(len(query)) - firsts[query] < n
        self.best = query[best], ids[best], score[best]
        full = np.flatnonzero(count >= n)
        self.least[full] = np.maximum(self.least[full], (score[firsts[full] + n - 1] - group.slack).astype(np.float32))


def _clean(table: DataFrame, key: str, vector: str, every: int) -> tuple[DataFrame, np.dtype, int, int, int]:
    """``(id, vec)`` of the rows that take part, with each vector as bytes; their type, length and number, and how many are queries."""
    kind = table.schema[vector].dataType.elementType
    number = "float" if isinstance(kind, T.FloatType) else "double"
    column = F.col(f"`{vector}`").cast(f"array<{number}>")
    rows = table.select(F.col(f"`{key}`").cast("long").alias("id"), column.alias("values"))
    bad = F.exists("values", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & ~bad & F.exists("values", lambda x: x != 0))
    counts = F.count(F.lit(1)).alias("count"), F.count_if(F.col("id") % every == 0).alias("queries")
    size = rows.groupBy(F.size("values").alias("n")).agg(*counts).orderBy(F.desc("count"), "n").first()
    dtype = np.dtype(np.float32 if number == "float" else np.float64)
    if size is None:
        return rows.select("id", F.lit(None).cast("binary").alias("vec")), dtype, 0, 0, 0
    width = size["n"]

    def pack(batches):
        for batch in batches:
            # Adding zero turns a negative zero into a positive one.
            values = batch.column("values").flatten().to_numpy(zero_copy_only=False).astype(dtype) + dtype.type(0)
            offsets = np.arange(len(batch) + 1, dtype=np.int32) * width * dtype.itemsize
            vec = pa.BinaryArray.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])
            yield pa.RecordBatch.from_arrays([batch.column("id"), vec], ["id", "vec"])

    return rows.filter(F.size("values") == width).mapInArrow(pack, "id long, vec binary"), dtype, width, size["count"], size["queries"]


def _matrix(column, dtype: np.dtype, width: int) -> np.ndarray:
    return k.flatten(column)[0].view(dtype).reshape(-1, width)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together until they have about so many rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def nearest_neighbours(
    table: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 50,
    neighbours: int = 5,
    sample_vectors: int = SAMPLE_VECTORS,
    recall: float = RECALL,
    block_entries: int = BLOCK_ENTRIES,
    least_entries: int = LEAST_ENTRIES,
) -> DataFrame:
    """The nearest rows to each row whose key is divisible by ``every``, of all other rows.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the cosine in double
    precision; ties go to the smaller key. Vectors that are null, empty or zero, or hold null or non-finite
    components, take no part, and neither do rows without a key, as they cannot be named, and vectors of
    another length than most, as no cosine is defined with them. Rows with one key count as one: each of
    its different vectors is a query, and as a neighbour its nearest one counts. Other
    columns are not looked at; an empty table gives an empty table.

    The centroids, and the share of the entries that a query must pass for about ``recall`` of the true neighbours, are
    learned from about ``sample_vectors`` distinct vectors drawn by hash; every vector is in the
    index. Equal vectors are one entry with its ``neighbours`` + 1 smallest keys, which is all that
    any query can need. No cell or query has a cap: large cells are cut into blocks, and each batch of queries meets
    the groups of blocks that it has cells in. Vectors without any structure need a large share; then this comes
    near to a comparison of the queries with all rows.
    """
    rows, dtype, width, n, asking = _clean(table, key, vector, every)
    result = "query_id long, rank int, vec_id long, score double"
    if asking == 0:
        return table.sparkSession.createDataFrame([], result)
    draw = F.pmod(F.xxhash64("vec"), F.lit(1_000_000))
    drawn = rows.filter(draw < int(min(1.0, sample_vectors / n) * 1_000_000)).select("vec").distinct().toArrow()
    sample = _matrix(drawn.sort_by("vec").column("vec"), dtype, width) if len(drawn) else np.ones((1, width), dtype)
    index = fit(sample, int(min(CENTROIDS, max(1, round((n / CELL_ENTRIES) ** 0.5)))), neighbours, recall)

    # Entries: distinct vectors, the smallest keys that have each, and its cell.
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    distinct = rows.distinct().withColumn("place", place).filter(F.col("place") <= neighbours + 1)
    distinct = distinct.groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids"))

    def encode(batches):
        for batch in batches:
            cell = index.cell(unit(_matrix(batch.column("vec"), dtype, width)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32))], ["vec", "ids", "cell"])

    entries = stage(distinct.mapInArrow(encode, "vec binary, ids array<long>, cell int"), "entries")
    counted = entries.groupBy("cell").count().toArrow()  # a row per cell at most
    sizes = np.zeros(index.cells, np.int64)
    sizes[counted.column("cell").to_numpy()] = counted.column("count").to_numpy()
    blocks = Blocks.of(sizes, block_entries)
    wanted = max(least_entries, neighbours + 1, int(np.ceil(index.share * sizes.sum())))

    # Rows of entries of each group.
    total = int(sizes.sum())
    held = width * dtype.itemsize  # bytes of a vector
    in_group = min(GROUP_BYTES // held, -(-total // LEAST_GROUPS)) + 1
    group = blocks.groups(in_group)
    cells = blocks.cells_by_group(group)
    packed = "part int, kind int, vecs binary, ids binary, cells binary, counts binary"
    fields = [pa.field("part", pa.int32()), pa.field("kind", pa.int32()), *(pa.field(x, pa.binary()) for x in ("vecs", "ids", "cells", "counts"))]

    def row(*values) -> pa.RecordBatch:
        data = [x if isinstance(x, int) else x.tobytes() for x in values]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(data, fields)], schema=pa.schema(fields))

    def deal(batches):
        for table in _gathered(batches, 8 * ROW_BYTES // held + 1):
            vectors, cell = _matrix(table.column("vec"), dtype, width), table.column("cell").to_numpy()
            own = group[blocks.first[cell] + table.column("part").to_numpy() % blocks.parts[cell]]
            ids = table.column("ids").combine_chunks()
            starts = ids.offsets.to_numpy()
            ids, counts, starts = ids.values.to_numpy(), np.diff(starts).astype(np.int32), starts[:-1]
            order = np.argsort(own, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
                for at in range(0, len(some), ROW_BYTES // held + 1):
                    few = some[at : at + ROW_BYTES // held + 1]
                    yield row(int(own[few[0]]), 0, vectors[few], ids[k.ranges(starts[few], counts[few])], cell[few].astype(np.int32), counts[few])

    part = F.pmod(F.xxhash64("vec"), F.lit(2**31 - 1)).alias("part")
    dealt = entries.select("vec", "ids", "cell", part).mapInArrow(deal, packed)

    # A row per batch of queries and group in which some of them have cells: the cells as bits, a row each.
    batch_size = max(256, min(QUERY_BATCH, ROW_BYTES // held))
    queries = rows.filter(F.col("id") % every == 0).repartition(-(-asking // batch_size), "id").distinct()
    queries = queries.withColumn("query", F.xxhash64("vec"))
    short = wanted * index.cells <= WALK_CELLS * total

    def probe(batches):
        by_centroid = sizes.reshape(len(index.first), len(index.second)).tolist() if short else None
        weights = sizes.astype(np.float64)
        for table in _gathered(batches, 4 * batch_size):
            parts = max(1, round(len(table) / batch_size))
            for some in np.array_split(np.arange(len(table)), parts):
                batch = table.slice(some[0], len(some))
                vectors = _matrix(batch.column("vec"), dtype, width)
                bits = np.zeros((index.cells, -(-len(some) // 8)), np.uint8)
                for at in range(0, len(some), 256):
                    a, b = index.to_centroids(unit(vectors[at : at + 256]))
                    passed = np.zeros((len(a), index.cells), bool)
                    for i in range(len(a)):
                        if short:
                            passed[i, walk(a[i], b[i], by_centroid, wanted)] = True
                        else:
                            passed[i] = select(a[i], b[i], weights, wanted)
                    new = np.packbits(passed, axis=0).T
                    bits[:, at // 8 : at // 8 + new.shape[1]] = new
                ids, query = batch.column("id").to_numpy(), batch.column("query").to_numpy()
                for own, its in cells.items():
                    masks = bits[its]
                    asked = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(masks, axis=0), count=len(some)))
                    if len(asked) == 0:
                        continue
                    if len(asked) < len(some):
                        masks = np.packbits(np.unpackbits(masks, axis=1, count=len(some))[:, asked], axis=1)
                    yield row(own, 1, vectors[asked], ids[asked], masks, query[asked])

    probes = queries.mapInArrow(probe, packed)
    # A partition has the entries of a group, then all that is asked of them.
    met = dealt.unionByName(probes).repartitionById(len(cells), F.col("part")).sortWithinPartitions("part", "kind")

    def rank(batches):
        at, own = None, None
        for batch in batches:
            for i in range(len(batch)):
                part, kind = batch.column("part")[i].as_py(), batch.column("kind")[i].as_py()
                vecs, ids, third, fourth = (batch.column(j)[i].as_buffer() for j in range(2, 6))
                vectors, ids = np.frombuffer(vecs, dtype).reshape(-1, width), np.frombuffer(ids, np.int64)
                if part != at:
                    at, own = part, None
                    own = Group(cells[part], dtype, width, 2 * in_group)
                if kind == 0:
                    own.add(vectors, np.frombuffer(third, np.int32), np.frombuffer(fourth, np.int32), ids)
                    continue
                if own.pieces:
                    own.close()
                masks, query = np.frombuffer(third, np.uint8).reshape(len(cells[part]), -1), np.frombuffer(fourth, np.int64)
                asked, near, score = Ranking(vectors, ids, masks, own, neighbours).run()
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[asked], query[asked], near, score)], ["query_id", "query", "vec_id", "score"])
        own = None
        k.release_memory()

    best = met.mapInArrow(rank, "query_id long, query long, vec_id long, score double")
    best = best.groupBy("query_id", "query", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= neighbours)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
