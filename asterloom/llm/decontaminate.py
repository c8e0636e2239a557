"""Benchmark passages in documents, found with an FM-index per shard of the corpus.

The phrases of the benchmark are searched backwards in the index of each shard through the ranks
of a wavelet matrix; where they stand is read from sampled suffix positions. The spans of all
phrases are merged per document.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm import chunks as c
from asterloom.llm import kernels as k

WINDOW_WORDS = 13
#: Words of benchmark items that are searched in one pass over the corpus.
PASS_WORDS = 2_000_000
SAMPLE = 8


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """64-bit hashes of the lower-cased words (see ``kernels.word_hashes`` for how often two agree),
    their starts and ends, and the first word of each text."""
    lower = k.LOWER[data]
    starts, ends, bounds = k.words(lower, offsets, k.ALPHANUMERIC)
    return k.word_hashes(lower, starts, ends, k.ALPHANUMERIC)[:, 0], starts, ends, bounds


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """All suffixes in order, by doubling the sorted prefix; a suffix that ends early is smaller."""
    n = len(symbols)
    low = max(1, int(n).bit_length())
    rank = np.unique(symbols, return_inverse=True)[1].astype(k.U) + k.U(1)
    reach = 1
    while True:
        after = np.zeros(n, k.U)
        after[: max(0, n - reach)] = rank[reach:]
        if 3 * low <= 64:
            key = np.sort((((rank << k.U(low)) | after) << k.U(low)) | np.arange(n, dtype=k.U))
            order = (key & k.U((1 << low) - 1)).astype(np.int64)
            key >>= k.U(low)
        else:
            order = np.lexsort((after, rank))
            key = (rank[order] << k.U(low)) | after[order]
        new = np.ones(n, bool)
        new[1:] = key[1:] != key[:-1]
        rank[order] = np.cumsum(new).astype(k.U)
        reach *= 2
        if new.all():
            return order


class WaveletMatrix:
    """Ranks of symbols in a sequence: one bit row per binary digit, highest first."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.levels = max(1, int(n_symbols - 1).bit_length())
        self.ones, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (symbols >> level) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbols: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low = np.zeros(len(symbols), np.int64)
        high = upto.astype(np.int64)
        for level, ones, zeros in zip(reversed(range(self.levels)), self.ones, self.zeros):
            bit = ((symbols >> level) & 1).astype(bool)
            low = np.where(bit, zeros + ones[low], low - ones[low])
            high = np.where(bit, zeros + ones[high], high - ones[high])
        return high - low


class FmIndex:
    """Searches phrases in a sequence of symbols from 1 on."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        symbols = np.append(symbols, 0)
        order = suffix_array(symbols)
        self.n_symbols = n_symbols
        self.last = symbols[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        self.matrix = WaveletMatrix(self.last, n_symbols)
        self.sampled = order % SAMPLE == 0
        self.sample_rank = np.concatenate([[0], np.cumsum(self.sampled)])
        self.samples = order[self.sampled]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of rows that begin with each phrase (all of one length), back to front."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last), np.int64)
        alive = np.arange(len(phrases))
        for place in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, place]
            base = self.before[symbol]
            low[alive] = base + self.matrix.rank(symbol, low[alive])
            high[alive] = base + self.matrix.rank(symbol, high[alive])
            dead = alive[low[alive] >= high[alive]]
            high[dead] = low[dead]
            alive = alive[low[alive] < high[alive]]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where the suffixes of rows begin: steps back to the next sampled one."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(~self.sampled[rows])
        while len(walking):
            symbol = self.last[rows[walking]]
            rows[walking] = self.before[symbol] + self.matrix.rank(symbol, rows[walking])
            steps[walking] += 1
            walking = walking[~self.sampled[rows[walking]]]
        return self.samples[self.sample_rank[rows]] + steps


class Phrases:
    """Distinct windows of the items' words, by length, with the items that have each."""

    def __init__(self, item_ids: list[str], hashes: list[np.ndarray], width: int):
        self.items = item_ids
        words = np.concatenate([*hashes, np.zeros(0, k.U)])
        self.vocabulary = np.unique(words)
        self.n_symbols = len(self.vocabulary) + 2
        by_length: dict[int, list] = {}
        for item, own in enumerate(hashes):
            n = min(width, len(own))
            if n:
                symbols = np.searchsorted(self.vocabulary, own) + 2
                for window in np.lib.stride_tricks.sliding_window_view(symbols, n):
                    by_length.setdefault(n, []).append((window.tobytes(), item))
        self.groups = []
        for n, found in sorted(by_length.items()):
            texts = {t: j for j, t in enumerate(dict.fromkeys(t for t, _ in found))}
            pairs = sorted({(texts[t], item) for t, item in found})
            phrase, item = (np.array([p[j] for p in pairs], np.int64) for j in (0, 1))
            table = np.frombuffer(b"".join(texts), np.int64).reshape(-1, n)
            self.groups.append((n, table, np.searchsorted(phrase, np.arange(len(texts) + 1)), item))
        self.shortest = min(by_length, default=0)

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of words from 2 on, 1 for words that no item has."""
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        return np.where(self.vocabulary[at] == hashes, at + 2, 1)


def occurrences(phrases: Phrases, hashes: np.ndarray, bounds: np.ndarray):
    """First word, length and phrase of each place where a window of an item stands.

    Phrases are numbered through all lengths; their items are not multiplied in, see ``shared``.

    Only stretches of benchmark words that are as long as the shortest phrase are indexed; each
    is followed by a word that no phrase has, as no phrase reaches over a stretch or a document.
    """
    none = np.zeros(0, np.int64)
    if not phrases.groups or len(hashes) == 0:
        return none, none, none
    symbols = phrases.symbols(hashes)
    firsts, lasts = k.runs(symbols > 1, bounds)
    long = lasts - firsts >= phrases.shortest
    firsts, lengths = firsts[long], (lasts - firsts)[long]
    if len(firsts) == 0:
        return none, none, none
    places = k.ranges(firsts, lengths + 1)
    text = symbols[np.minimum(places, len(symbols) - 1)]
    text[np.cumsum(lengths + 1) - 1] = 1
    index = FmIndex(text, phrases.n_symbols)
    found, before = [], 0
    for n, table, _, _ in phrases.groups:
        low, high = index.search(table)
        some = np.flatnonzero(high > low)
        if len(some):
            at = places[index.locate(k.ranges(low[some], high[some] - low[some]))]
            phrase = np.repeat(some, high[some] - low[some])
            found.append((at, np.full(len(at), n), before + phrase))
        before += len(table)
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (none, none, none)


def found_items(phrases: Phrases, bounds: np.ndarray, first: np.ndarray, phrase: np.ndarray):
    """Distinct documents and phrases, the phrases by their place among those found, with each one's items."""
    known, place = np.unique(phrase, return_inverse=True)
    pairs = np.unique((np.searchsorted(bounds, first, "right") - 1) * max(1, len(known)) + place)
    lists, before = [], 0
    for _, table, bound, items in phrases.groups:
        own = known[(known >= before) & (known < before + len(table))] - before
        lists += [items[bound[j] : bound[j + 1]] for j in own]
        before += len(table)
    names = [phrases.items[j] for j in np.concatenate([*lists, np.zeros(0, np.int64)])]
    return pairs // max(1, len(known)), pairs % max(1, len(known)), np.cumsum([0, *map(len, lists)]), names


def shared(n_docs: int, parts: list) -> pa.Array:
    """The items of each document, sorted, from the parts that ``found_items`` gives."""
    names = sorted({j for *_, items in parts for j in items if j is not None})
    place = {j: r for r, j in enumerate(names)}
    found = [np.zeros(0, np.int64)]
    for doc, phrase, bound, items in parts:
        number = np.array([place.get(j, -1) for j in items], np.int64)
        count = bound[phrase + 1] - bound[phrase]
        own = number[k.ranges(bound[phrase], count)]
        found.append((np.repeat(doc, count) * len(names) + own)[own >= 0])
    pairs = np.unique(np.concatenate(found))
    doc, item = pairs // max(1, len(names)), pairs % max(1, len(names))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n_docs + 1)), pa.int32()), pa.array(names, pa.string()).take(pa.array(item)))


def read_phrases(items: DataFrame, width: int) -> Phrases:
    """The phrases of the given items, which are a pass's share of the benchmark."""
    table = items.toArrow()
    data, offsets = k.flatten(table.column("text"))
    hashes, _, _, bounds = word_hashes(data, offsets)
    return Phrases(table.column("item").to_pylist(), np.split(hashes, bounds[1:-1]) if len(table) else [], width)


def search(chunks: DataFrame, phrases: Phrases) -> DataFrame:
    """``(chunk, hits)``: where the phrases stand in each chunk, which documents have which, and their items."""

    def run(batches):
        for chunk, _, _ in c.each(batches):
            hashes, _, _, bounds = word_hashes(chunk.data, chunk.offsets)
            first, length, phrase = occurrences(phrases, hashes, bounds)
            doc, place, bound, names = found_items(phrases, bounds, first, phrase)
            hits = [{"spans": np.stack([first, length]).tobytes(), "pairs": np.stack([doc, place]).tobytes(), "bound": bound.tobytes(), "items": names}]
            yield pa.RecordBatch.from_arrays([pa.array([chunk.id], pa.int64()), pa.array(hits, kind)], ["chunk", "hits"])

    kind = pa.struct([("spans", pa.binary()), ("pairs", pa.binary()), ("bound", pa.binary()), ("items", pa.list_(pa.string()))])
    return chunks.mapInArrow(run, "chunk long, hits struct<spans: binary, pairs: binary, bound: binary, items: array<string>>")


def merged(bounds: np.ndarray, first: np.ndarray, length: np.ndarray, parts: list) -> list[pa.Array]:
    """Per document: words, hit words, merged spans, items, and whether a twentieth is hit."""
    gone = np.zeros(bounds[-1], bool)
    gone[k.ranges(first, length)] = True
    firsts, lasts = k.runs(gone, bounds)
    n_words, n_hit = np.diff(bounds), k.sums_between(gone, bounds)
    lists = np.stack([firsts, lasts], 1) - bounds[np.searchsorted(bounds, firsts, "right") - 1][:, None]
    pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(lists) + 1, 2), pa.int32()), pa.array(lists.ravel(), pa.int64()))
    return [
        pa.array(n_words),
        pa.array(n_hit),
        pa.ListArray.from_arrays(pa.array(np.searchsorted(firsts, bounds), pa.int32()), pairs),
        shared(len(bounds) - 1, parts),
        pa.array((n_hit > 0) & (20 * n_hit >= n_words)),
    ]


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    width: int = WINDOW_WORDS,
    pass_words: int = PASS_WORDS,
    keep_text: bool = False,
) -> DataFrame:
    """The documents with what they share with the items of a benchmark.

    Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z in lower
    case. A window is ``width`` consecutive words of an item; an item of fewer words is one
    window, one of none has none. Added columns: ``n_words``, ``n_hit`` (words inside any
    occurrence of a window), ``spans`` (merged, ``[first, end)`` in words), ``item_ids`` (as
    strings, sorted) and ``contaminated``: at least a twentieth of the words are hit. Null texts
    have no words, null item ids are skipped in ``item_ids``; the text itself is the first of the
    added columns with ``keep_text``, else it is left out; repeated rows are documents of their own;
    empty tables give no hits or no rows.

    The items are a stated query set. They are taken to the tasks in passes of at most about
    ``pass_words`` words, each a search of all documents.
    """
    size = benchmark.agg(F.coalesce(F.sum(F.length(F.col(f"`{item_text}`"))), F.lit(0))).first()[0]
    passes = max(1, -(-size // (5 * pass_words)))
    items = benchmark.select(F.col(f"`{item_key}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("text"))
    frame, names = c.by_position(docs)
    chunks = c.chunked(frame, f"c{names.index(text)}")
    if passes == 1:
        phrases = read_phrases(items, width)

        def process(chunk, batch, i):
            hashes, _, _, bounds = word_hashes(chunk.data, chunk.offsets)
            first, length, phrase = occurrences(phrases, hashes, bounds)
            return merged(bounds, first, length, [found_items(phrases, bounds, first, phrase)])

    else:
        chunks = c.stage(chunks, "chunks")
        number = F.pmod(F.xxhash64("item", "text"), F.lit(passes))
        # A pass is done before the phrases of the next one are read, so the driver holds those of one.
        found = [c.stage(search(chunks, read_phrases(items.filter(number == p), width)), "hits") for p in range(passes)]
        hits = reduce(DataFrame.unionByName, found)
        chunks = chunks.join(hits.groupBy("chunk").agg(F.collect_list("hits").alias("hits")), "chunk", "left")

        def process(chunk, batch, i):
            _, _, _, bounds = word_hashes(chunk.data, chunk.offsets)
            hits = batch.column("hits")[i]
            hits = [x for x in hits.as_py() if x["items"]] if hits.is_valid else []
            spans = [np.frombuffer(x["spans"], np.int64).reshape(2, -1) for x in hits]
            first, length = np.concatenate([*spans, np.zeros((2, 0), np.int64)], axis=1)
            parts = [(*np.frombuffer(x["pairs"], np.int64).reshape(2, -1), np.frombuffer(x["bound"], np.int64), x["items"]) for x in hits]
            return merged(bounds, first, length, parts)

    added = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("contaminated", T.BooleanType()),
    ]
    if keep_text:
        added = [T.StructField(text, T.StringType()), *added]
        out = c.unpack(chunks, lambda chunk, batch, i: [chunk.texts(), *process(chunk, batch, i)], added)
    else:
        out = c.unpack(chunks, process, added)
    return out.toDF(*[n for n in names if n != text], *[f.name for f in added])
