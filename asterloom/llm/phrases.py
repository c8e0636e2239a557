"""Collocations: phrases whose words stand together more often than their parts would by chance.

Counts of phrases are held in weighted acyclic automata: a path spells a phrase, and the state it
ends in has the number of places where the phrase stands. Each shard of documents builds automata
from its sorted n-grams, cut at the bounds of prefix ranges; those of a range are united and their weights summed;
and the parts of the phrases found are looked up by composing an automaton of parts with that of the counts.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asterloom.llm import kernels as k
from asterloom.llm.chunks import binary_array, by_position, squeeze, stage, text_bytes, unsqueeze

UNDETERMINED = "und"
LEAST, LONGEST, TOP = 100, 5, 2000
#: Bytes of text of a shard, about. Longer texts are cut where a piece ends.
SHARD_BYTES = 4_000_000
#: Distinct hashes that a task gathers before it sends them, and that a bucket counts, about.
HELD_HASHES, BUCKET_HASHES = 2_000_000, 1_000_000
#: Bits of the table of frequent words and pairs: so many for each, within these bounds (16 MB at most).
BITS_EACH, LEAST_BITS, MOST_BITS = 64, 1 << 16, 1 << 27
#: Windows drawn over the corpus to bound the prefix ranges; windows of a range in all shards, about; and the most ranges.
SAMPLE_WINDOWS, RANGE_WINDOWS, RANGES = 50_000, 2_000_000, 20_000

#: What ends a piece: . , ; : ! ? and 0A to 0D. Pieces are made of words parted by spaces and tabs.
ENDS_PIECE = np.zeros(256, bool)
ENDS_PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IN_WORD = ~ENDS_PIECE
IN_WORD[[0x20, 0x09]] = False

Phrase = tuple[bytes, ...]
Bound = tuple[str, Phrase]


# --- automata -------------------------------------------------------------------------


class Automaton:
    """States with weights, and arcs by label in order; the last state is where all paths begin."""

    def __init__(self, words: list[bytes], weights: np.ndarray, counts: np.ndarray, labels: np.ndarray, targets: np.ndarray):
        self.words, self.weights, self.counts, self.labels, self.targets = words, weights, counts, labels, targets
        self.first = np.cumsum(counts) - counts

    def pack(self) -> bytes:
        numbers = [np.array([len(self.weights), len(self.labels)]), self.weights, self.counts, self.labels, self.targets]
        words = np.frombuffer(b" ".join(self.words), np.uint8)
        return squeeze(np.concatenate([np.concatenate(numbers).astype(np.int64).view(np.uint8), words]))

    @classmethod
    def unpack(cls, value: pa.Scalar) -> Automaton:
        data = unsqueeze(value)
        n, m = data[:16].view(np.int64)
        ends = 8 * np.cumsum([2, n, n, m, m])
        weights, counts, labels, targets = (data[a:b].view(np.int64) for a, b in zip(ends[:-1], ends[1:]))
        return cls(data[ends[-1] :].tobytes().split(b" ") if m else [], weights, counts, labels, targets)

    def paths(self) -> Iterator[tuple[Phrase, int]]:
        """All phrases in order, with their weights."""

        def below(state, phrase):
            for at in range(self.first[state], self.first[state] + self.counts[state]):
                longer = (*phrase, self.words[self.labels[at]])
                yield longer, int(self.weights[self.targets[at]])
                yield from below(self.targets[at], longer)

        yield from below(len(self.weights) - 1, ())


class Builder:
    """Builds the smallest automaton of phrases that come in order, one after the other.

    What a phrase does not share with the one before is finished when the next one comes: a
    finished state that weighs the same and has the same arcs as an earlier one is replaced by it.
    """

    def __init__(self):
        self.known: dict[tuple, int] = {}
        self.weights: list[int] = []
        self.arcs: list[tuple] = []
        self.path: list[int] = []
        self.path_weights: list[int] = [0]
        self.path_arcs: list[list[int]] = [[]]

    def finish(self, depth: int) -> None:
        while len(self.path) > depth:
            state = (self.path_weights.pop(), *self.path_arcs.pop())
            number = self.known.get(state)
            if number is None:
                number = self.known[state] = len(self.weights)
                self.weights.append(state[0])
                self.arcs.append(state[1:])
            self.path_arcs[-1] += (self.path.pop(), number)

    def add(self, labels: list[int], shared: int, weight: int, along: bool) -> None:
        """A phrase that has ``shared`` labels in common with the one before; it weighs on its last
        state, or on all states along its path."""
        self.finish(shared)
        self.path += labels[shared:]
        for _ in range(len(labels) - shared):
            self.path_weights.append(0)
            self.path_arcs.append([])
        if along:
            for depth in range(1, len(labels) + 1):
                self.path_weights[depth] += weight
        else:
            self.path_weights[-1] += weight

    def automaton(self, words: list[bytes]) -> Automaton:
        """The automaton of all that was added, with the words its labels stand for."""
        self.finish(0)
        arcs = [*self.arcs, tuple(self.path_arcs[0])]
        flat = np.array([x for a in arcs for x in a], np.int64).reshape(-1, 2)
        used, labels = np.unique(flat[:, 0], return_inverse=True)
        counts = np.array([len(a) // 2 for a in arcs], np.int64)
        return Automaton([words[j] for j in used], np.array([*self.weights, 0], np.int64), counts, labels.ravel().astype(np.int64), flat[:, 1])


def of_phrases(phrases: Iterable[tuple[Phrase, int]]) -> Automaton:
    """The automaton of phrases in order, each with its weight."""
    phrases = list(phrases)
    words = sorted({w for p, _ in phrases for w in p})
    place = {w: j for j, w in enumerate(words)}
    builder, before = Builder(), []
    for phrase, weight in phrases:
        labels = [place[w] for w in phrase]
        shared = next((j for j, (a, b) in enumerate(zip(labels, before)) if a != b), min(len(labels), len(before)))
        builder.add(labels, shared, weight, along=False)
        before = labels
    return builder.automaton(words)


def _side_by_side(automata: list[Automaton]):
    """All states and arcs in one numbering, with common labels, and where the paths of each begin."""
    words = sorted({w for a in automata for w in a.words})
    place = {w: j for j, w in enumerate(words)}
    states = np.cumsum([0, *[len(a.weights) for a in automata]])
    arcs = np.cumsum([0, *[len(a.labels) for a in automata]])
    first = np.concatenate([a.first + at for a, at in zip(automata, arcs)])
    labels = np.concatenate([np.array([place[w] for w in a.words], np.int64)[a.labels] if a.words else a.labels for a in automata])
    targets = np.concatenate([a.targets + at for a, at in zip(automata, states)])
    return words, np.concatenate([a.weights for a in automata]), first, np.concatenate([a.counts for a in automata]), labels, targets, states[1:] - 1


def union(automata: list[Automaton], least: int, edges: Iterable[Phrase] = ()) -> list[tuple[Phrase, int]]:
    """The phrases of all automata with their summed weights, as far as these reach ``least``.

    Weights are along paths, so nothing below a phrase weighs more than it, and what lies below a
    lighter one is not looked at. Phrases that an edge begins with are kept whatever they weigh, as other
    ranges have a part of their weight.
    """
    words, weights, first, counts, labels, targets, roots = _side_by_side(automata)
    place = {w: j for j, w in enumerate(words)}
    phrases, at_edge = [()], [[e for e in edges]]
    node, state, out = np.zeros(len(roots), np.int64), roots, []
    while len(state):
        arcs = k.ranges(first[state], counts[state])
        key = np.repeat(node, counts[state]) * max(1, len(words)) + labels[arcs]
        order = np.argsort(key, kind="stable")
        key, reached = key[order], targets[arcs][order]
        if len(key) == 0:
            break
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        total = np.add.reduceat(weights[reached], heads)
        kept = total >= least
        parent, label = key[heads] // max(1, len(words)), key[heads] % max(1, len(words))
        for p, own in enumerate(at_edge):
            for e in own:
                if len(e) > len(phrases[p]) and e[len(phrases[p])] in place:
                    kept |= (parent == p) & (label == place[e[len(phrases[p])]])
        longer, edge = [], []
        for p, w, n in zip(parent[kept].tolist(), label[kept].tolist(), total[kept].tolist()):
            longer.append((*phrases[p], words[w]))
            edge.append([e for e in at_edge[p] if len(e) > len(phrases[p]) and e[len(phrases[p])] == words[w]])
            out.append((longer[-1], n))
        number = np.cumsum(kept) - 1
        group = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(key))))
        inside = kept[group]
        node, state, phrases, at_edge = number[group[inside]], reached[inside], longer, edge
    return out


def compose(parts: Automaton, counts: Automaton) -> list[tuple[Phrase, int]]:
    """The parts with their weights in ``counts``: both automata are walked along equal labels.

    Parts are the phrases of weight 1 or more; those that ``counts`` does not have are left out.
    """
    place = {w: j for j, w in enumerate(counts.words)}
    translated = [place.get(w, -1) for w in parts.words]
    out: list[tuple[Phrase, int]] = []
    todo = [(len(parts.weights) - 1, len(counts.weights) - 1, ())]
    while todo:
        p, c, phrase = todo.pop()
        low, high = counts.first[c], counts.first[c] + counts.counts[c]
        for at in range(parts.first[p], parts.first[p] + parts.counts[p]):
            label = translated[parts.labels[at]]
            to = low + np.searchsorted(counts.labels[low:high], label)
            if label < 0 or to == high or counts.labels[to] != label:
                continue
            longer, state = (*phrase, counts.words[label]), counts.targets[to]
            if parts.weights[parts.targets[at]] > 0:
                out.append((longer, int(counts.weights[state])))
            todo.append((parts.targets[at], state, longer))
    return out


# --- words of shards --------------------------------------------------------------------


def shards(batches: Iterator[pa.RecordBatch], size: int = SHARD_BYTES) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """Language, bytes and offsets of texts of one language, up to about ``size`` bytes together.

    Longer texts are cut where a piece ends, so no phrase is lost. Columns: language, text in bytes.
    """
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def flush(lang):
        texts = held.pop(lang)
        del sizes[lang]
        return lang, np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for part in cut_long(text or b"", size):
                held.setdefault(lang, []).append(part)
                sizes[lang] = sizes.get(lang, 0) + len(part)
                if sizes[lang] >= size:
                    yield flush(lang)
            if sum(sizes.values()) >= 4 * size:
                yield flush(max(sizes, key=sizes.get))
        k.release_memory()
    while held:
        yield flush(next(iter(held)))


def cut_long(text: bytes, size: int) -> list[bytes]:
    """The text, or slices of about ``size`` bytes that end where pieces end."""
    if len(text) <= size:
        return [text]
    ends = np.flatnonzero(ENDS_PIECE[np.frombuffer(text, np.uint8)]) + 1
    at = ends[np.searchsorted(ends, np.arange(size, len(text), size)).clip(max=max(0, len(ends) - 1))] if len(ends) else ends
    edges = [0, *np.unique(at).tolist(), len(text)]
    return [text[a:b] for a, b in zip(edges[:-1], edges[1:]) if b > a]


def seed_of(lang: str) -> np.uint64:
    return k.U(int.from_bytes(lang.encode()[:64].ljust(64, b"\0"), "little") % 0xFFFFFFFFFFFFFFC5)


class Words:
    """The words of a shard: bytes, hash of each, and whether it stands in one piece with the next.

    Hashes only tell which words and pairs can be frequent. Two that share one are counted
    together there, so none that is frequent is missed; counts in results never rest on hashes.
    """

    def __init__(self, lang: str, data: np.ndarray, offsets: np.ndarray):
        self.data = k.LOWER[data]
        self.starts, self.ends, bounds = k.words(self.data, offsets, IN_WORD)
        ended = np.cumsum(ENDS_PIECE[self.data], dtype=np.int32)
        self.joined = np.zeros(len(self.starts), bool)
        self.joined[:-1] = ended[self.starts[1:]] == ended[self.starts[:-1]]
        self.joined[bounds[(bounds > 0) & (bounds <= len(self.starts))] - 1] = False
        own = k.Rolling(k.BYTE_VALUES[self.data])(self.starts, self.ends) + (self.ends - self.starts).astype(k.U)
        self.hashes = k.mix(own + seed_of(lang))
        self.pairs = k.mix(self.hashes[:-1] * k.U(0xC2B2AE3D27D4EB4F) + self.hashes[1:], 7)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def window(self, i: int, longest: int) -> bytes:
        """The words from one on, up to the end of the piece or the longest phrase."""
        last = i
        while last < i + longest - 1 and self.joined[last]:
            last += 1
        return b" ".join(self.text(j) for j in range(i, last + 1))

    def runs(self, frequent: Callable, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """Which words can be frequent, and how many frequent pairs follow in a row on each, ``longest`` - 1 at most."""
        often = frequent(self.hashes)
        pair = np.zeros(len(often), bool)
        pair[:-1] = self.joined[:-1] & often[:-1] & often[1:] & frequent(self.pairs)
        following, run = np.zeros(len(often), np.int64), pair.copy()
        for step in range(1, longest):
            following += run
            run[:-step] &= pair[step:]
            run[-step:] = False
        return often, following


def distinct_windows(words: Words, frequent: Callable, longest: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The words that count, in order, and distinct windows of them in order (numbers from 1 on, 0 for none) with their counts.

    The window of a word goes on as long as pairs can be frequent: longer phrases cannot be.
    """
    often, following = words.runs(frequent, longest)
    at = np.flatnonzero(often)
    if len(at) == 0:
        return [], np.zeros((0, longest), np.int64), np.zeros(0, np.int64)
    lengths = words.ends[at] - words.starts[at]
    texts = binary_array(words.data[k.ranges(words.starts[at], lengths)], np.concatenate([[0], np.cumsum(lengths)])).dictionary_encode()
    vocabulary = texts.dictionary.to_pylist()
    order = sorted(range(len(vocabulary)), key=vocabulary.__getitem__)
    number = np.empty(len(vocabulary), np.int64)
    number[order] = np.arange(1, len(order) + 1)
    ids = np.zeros(len(often) + longest, np.int64)
    ids[at] = number[texts.indices.to_numpy()]
    windows = np.stack([np.where(following[at] >= j, ids[at + j], 0) for j in range(longest)], axis=1)
    bits = int(len(vocabulary)).bit_length()
    each = max(1, 63 // bits)
    keys = []
    for low in range(0, longest, each):
        key = np.zeros(len(windows), np.int64)
        for j in range(low, min(low + each, longest)):
            key = (key << bits) | windows[:, j]
        keys.append(key)
    by_key = np.lexsort(keys[::-1])
    new = np.zeros(len(by_key), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[by_key[1:]] != key[by_key[:-1]]
    heads = np.flatnonzero(new)
    return [vocabulary[j] for j in order], windows[by_key[heads]], np.diff(np.append(heads, len(by_key)))


def shard_automata(lang: str, vocabulary: list[bytes], windows: np.ndarray, counts: np.ndarray, bounds: list[Bound]) -> Iterator[tuple[int, Automaton]]:
    """Prefix ranges and the automaton of the shard's windows in each."""
    lengths = (windows > 0).sum(axis=1)
    shared = np.zeros(len(windows), np.int64)
    if len(windows) > 1:
        same = np.logical_and.accumulate((windows[1:] == windows[:-1]) & (windows[1:] > 0), axis=1)
        shared[1:] = same.sum(axis=1)
    first = bisect_left(bounds, (lang, ()))
    last = bisect_right(bounds, (lang + "\0", ()))
    key = lambda i: tuple(vocabulary[j - 1] for j in windows[i, : lengths[i]])
    cuts = [0, *[bisect_left(range(len(windows)), phrase, key=key) for _, phrase in bounds[first:last]], len(windows)]
    rows, lengths, shared, counts = (windows - 1).tolist(), lengths.tolist(), shared.tolist(), counts.tolist()
    for j, (low, high) in enumerate(zip(cuts[:-1], cuts[1:])):
        if high > low:
            builder = Builder()
            for i in range(low, high):
                builder.add(rows[i][: lengths[i]], shared[i] if i > low else 0, counts[i], along=True)
            yield first + j, builder.automaton(vocabulary)


# --- Spark ------------------------------------------------------------------------------


def _bits(hashes: DataFrame) -> np.ndarray:
    """A table of bits that are set for the given hashes, of a bounded size: any number of hashes may share one."""
    n = hashes.count()
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (max(1, n) * BITS_EACH - 1).bit_length()))
    slot = F.col("hash").bitwiseAND(F.lit(size - 1))
    rows = hashes.select(F.shiftright(slot, 6).alias("place"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    # At most size / 64 rows.
    rows = rows.groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(size // 64, np.int64)
    table[rows.column("place").to_numpy()] = rows.column("bits").to_numpy()
    return table.view(k.U)


def _in_bits(table: np.ndarray) -> Callable:
    """Whether the bit of each hash is set."""

    def frequent(hashes: np.ndarray) -> np.ndarray:
        slot = hashes & k.U(64 * len(table) - 1)
        return ((table[(slot >> k.U(6)).astype(np.int64)] >> (slot & k.U(63))) & k.U(1)).astype(bool)

    return frequent


def _frequent(texts: DataFrame, total: int, least: int, longest: int, shard_bytes: int, ranges: int) -> tuple[np.ndarray, list[Bound]]:
    """Bits of words and pairs that can be frequent, and bounds of the prefix ranges.

    A task counts the hashes of its words and pairs and sends each once, in order, by ranges of the hashes. About
    ``SAMPLE_WINDOWS`` windows of the corpus are drawn in the same pass.
    """
    buckets = max(12, -(-total // (10 * BUCKET_HASHES)))
    rate = min(1.0, SAMPLE_WINDOWS / max(1, total // 6))
    borders = np.array([(i << 64) // buckets for i in range(buckets)], k.U)
    drawn_below = k.U(min(2**64 - 1, int(rate * 2**64)))
    names = ["bucket", "hashes", "counts", "lang", "sample"]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.binary()]

    def rows(columns):
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], names)

    def send(batches):
        held, n_held = [], 0

        def flush():
            hashes, counts = _summed(held)
            at = np.append(np.searchsorted(hashes, borders), len(hashes))
            for b in np.flatnonzero(np.diff(at)):
                own = slice(at[b], at[b + 1])
                yield rows([[b], [hashes[own].tobytes()], [squeeze(counts[own].astype(np.uint32))], [None], [None]])

        for lang, data, offsets in shards(batches, shard_bytes):
            words = Words(lang, data, offsets)
            if len(words.starts) == 0:
                continue
            held.append(np.unique(np.concatenate([words.hashes, words.pairs[words.joined[:-1]]]), return_counts=True))
            n_held += len(held[-1][0])
            if n_held >= HELD_HASHES:
                held = [_summed(held)]
                n_held = len(held[0][0])
                if 2 * n_held >= HELD_HASHES:
                    yield from flush()
                    held, n_held = [], 0
            place = k.mix(words.hashes + np.arange(len(words.hashes), dtype=k.U), 3)
            drawn = [words.window(i, longest) for i in np.flatnonzero(place <= drawn_below)]
            if drawn:
                # The windows of a shard are one row, in one of several groups.
                yield rows([[-1 - int(words.hashes[0] % k.U(buckets))], [None], [None], [lang], [b"\n".join(drawn)]])
        if held:
            yield from flush()

    def count(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            both = zip(table.column("lang").to_pylist(), table.column("sample").to_pylist())
            langs, drawn = zip(*[(lang, x) for lang, own in both for x in own.split(b"\n")])
            columns = [pa.nulls(len(langs), pa.int64()), pa.array(langs, pa.string()), pa.array(drawn, pa.binary())]
            return pa.Table.from_arrays(columns, ["hash", "lang", "sample"])
        blocks = zip(table.column("hashes"), table.column("counts"))
        hashes, counts = _summed([(np.frombuffer(h.as_buffer(), k.U), unsqueeze(n).view(np.uint32)) for h, n in blocks])
        hashes = hashes[counts >= least].view(np.int64)
        k.release_memory()
        return pa.Table.from_arrays([pa.array(hashes), pa.nulls(len(hashes), pa.string()), pa.nulls(len(hashes), pa.binary())], ["hash", "lang", "sample"])

    sent = texts.mapInArrow(send, "bucket int, hashes binary, counts binary, lang string, sample binary")
    found = stage(sent.groupBy("bucket").applyInArrow(count, "hash long, lang string, sample binary"), "frequent", small=True)
    table = _bits(found.filter(F.col("hash").isNotNull()).select("hash"))
    sample = found.filter(F.col("hash").isNull()).select("lang", "sample").distinct().toArrow()
    return table, range_bounds(sample.column("lang").to_pylist(), sample.column("sample").to_pylist(), _in_bits(table), longest, ranges)


def _summed(blocks: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of all blocks in order, and their summed counts."""
    hashes = np.concatenate([h for h, _ in blocks])
    counts = np.concatenate([n for _, n in blocks]).astype(np.int64)
    if len(hashes) == 0:
        return hashes, counts
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[heads], np.add.reduceat(counts[order], heads)


def range_bounds(langs: list[str], drawn: list[bytes], frequent: Callable, longest: int, ranges: int) -> list[Bound]:
    """Windows that cut the order of all windows into ranges of about the same size, from drawn ones."""
    found = set()
    for lang in sorted(set(langs)):
        own = [s for x, s in zip(langs, drawn) if x == lang]
        words = Words(lang, np.frombuffer(b"\n".join(own) + b"\n", np.uint8), np.array([0, sum(map(len, own)) + len(own)]))
        often, following = words.runs(frequent, longest)
        for i in np.flatnonzero(often & ~np.concatenate([[False], words.joined[:-1]])):
            found.add((lang, tuple(words.text(j) for j in range(i, i + 1 + following[i]))))
    ordered = sorted(found)
    n = min(RANGES, len(ordered), ranges)
    return [ordered[i * len(ordered) // n] for i in range(1, n)]


def phrase_counts(texts: DataFrame, least: int, longest: int, shard_bytes: int, range_windows: int = RANGE_WINDOWS) -> tuple[DataFrame, DataFrame, list[Bound]]:
    """``(lang, phrase, words, f)`` of all phrases that stand ``least`` times, ``(lang, n)``, and the bounds of the ranges."""
    total = text_bytes(texts, "text")
    table, bounds = _frequent(texts, total, least, longest, shard_bytes, total // (6 * range_windows))
    frequent = _in_bits(table)

    def build(batches):
        for lang, data, offsets in shards(batches, shard_bytes):
            words = Words(lang, data, offsets)
            columns = [[-1], [lang], [None], [len(words.starts)]]
            if len(words.starts):
                for place, automaton in shard_automata(lang, *distinct_windows(words, frequent, longest), bounds):
                    for column, value in zip(columns, (place, lang, automaton.pack(), None)):
                        column.append(value)
            kinds = (pa.int32(), pa.string(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], ["place", "lang", "automaton", "n"])

    pieces = stage(texts.mapInArrow(build, "place int, lang string, automaton binary, n long"), "automata")
    sizes = pieces.filter("place < 0").groupBy("lang").agg(F.sum("n").alias("n"))

    def unite(rows: pa.Table) -> pa.Table:
        place = rows.column("place")[0].as_py()
        edges = bounds[max(0, place - 1) : place + 1]
        langs, columns = rows.column("lang").to_pylist(), [[], [], [], []]
        for lang in sorted(set(langs)):
            automata = [Automaton.unpack(rows.column("automaton")[i]) for i, x in enumerate(langs) if x == lang]
            for phrase, f in union(automata, least, [p for x, p in edges if x == lang]):
                for column, value in zip(columns, (lang, b" ".join(phrase), len(phrase), f)):
                    column.append(value)
        kinds = (pa.string(), pa.binary(), pa.int32(), pa.int64())
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], ["lang", "phrase", "words", "f"])

    found = pieces.filter("place >= 0").select("place", "lang", "automaton").groupBy("place").applyInArrow(unite, "lang string, phrase binary, words int, f long")
    # A phrase that a bound begins with has its count in parts.
    found = found.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return stage(found, "counts", small=True), sizes, bounds


def _placed(phrases: DataFrame, column: str, bounds: list[Bound]) -> DataFrame:
    """The frame with the prefix range of a phrase."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in phrases.schema)

    def run(batches):
        for batch in batches:
            both = zip(batch.column("lang").to_pylist(), batch.column(column).to_pylist())
            place = [bisect_right(bounds, (lang, tuple(p.split(b" ")))) for lang, p in both]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int32())], [*batch.schema.names, "place"])

    return phrases.mapInArrow(run, f"{schema}, place int")


def look_up(parts: DataFrame, counts: DataFrame, bounds: list[Bound]) -> DataFrame:
    """``(lang, phrase, f)`` of the given ``(lang, phrase)``, each once, by composition in each prefix range."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = [[], [], []]

        def by_lang(rows, weight):
            out: dict[str, list] = {}
            for lang, phrase, f in zip(rows.column("lang").to_pylist(), rows.column("phrase").to_pylist(), weight):
                out.setdefault(lang, []).append((tuple(phrase.split(b" ")), f))
            return {lang: of_phrases(sorted(x)) for lang, x in out.items()}

        known = by_lang(right, right.column("f").to_pylist() if len(right) else [])
        for lang, asked in by_lang(left, [1] * len(left)).items():
            for phrase, f in compose(asked, known[lang]) if lang in known else []:
                for column, value in zip(columns, (lang, b" ".join(phrase), f)):
                    column.append(value)
        kinds = (pa.string(), pa.binary(), pa.int64())
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], ["lang", "phrase", "f"])

    left = _placed(parts.select("lang", "phrase"), "phrase", bounds).groupBy("place")
    right = _placed(counts.select("lang", "phrase", "f"), "phrase", bounds).groupBy("place")
    return left.cogroup(right).applyInArrow(meet, "lang string, phrase binary, f long")


def _sub_phrases(words: Column) -> Column:
    """All shorter phrases of two words or more within one."""
    n = F.size(words)
    lengths = lambda i: F.sequence(F.lit(2), F.least(n - i + 1, n - 1))
    return F.flatten(F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.transform(lengths(i), lambda m: F.array_join(F.slice(words, i, m), " "))))


def lowest_cut(a: int, n: int, cuts: list[tuple[int, int, int]], scale: int) -> tuple[int, int, int]:
    """The lowest score of ``(words before, l, r)`` cuts, rounded down, and the l and r of the first one with it."""
    score, _, left, right = min((scale * a * n // (left * right), before, left, right) for before, left, right in cuts)
    return score, left, right


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    longest: int = LONGEST,
    top: int = TOP,
    scale: int = 1000,
    absorbed: int = 100,
    shard_bytes: int = SHARD_BYTES,
    range_windows: int = RANGE_WINDOWS,
) -> DataFrame:
    """The ``top`` phrases of each language by how much more often they stand than their parts would by chance.

    A-Z are lower-cased; texts are split into pieces at ``. , ; : ! ?`` and 0A to 0D, pieces into words at
    spaces and tabs. All counts are per language (null: ``und``) and over all texts: ``n`` of all words, ``a`` of a
    phrase of 2 to ``longest`` words, counted at every place within pieces. Phrases with at least ``least`` are
    candidates. Cut after some of its words into parts with counts ``l`` and ``r``, a phrase scores ``scale * a * n / (l * r)``, rounded
    down; its lowest score counts, of equal ones that of the shortest first part. A candidate within a longer one
    that has at least ``absorbed`` percent of its count is dropped, also if that one is dropped itself. Returns ``lang``, ``rank``,
    ``phrase`` (words joined by spaces), ``a``, ``l``, ``r``, ``n`` and ``score``, ordered by score, a (both descending) and the bytes
    of the phrase. Null and empty texts have no words; repeated rows count each; texts of any length are counted whole; an empty table gives an
    empty table. Other columns are not looked at.

    Counts are exact. Hashes are used for one thing: to leave out words and pairs that cannot be
    frequent. A phrase that stands in a third of all texts costs each shard one path.
    """
    frame, names = by_position(docs)
    own, here = F.col(f"c{names.index(lang)}"), F.col(f"c{names.index(text)}")
    texts = frame.select(F.coalesce(own.cast("string"), F.lit(UNDETERMINED)).alias("lang"), here.cast("binary").alias("text"))
    counts, sizes, bounds = phrase_counts(texts, least, longest, shard_bytes, range_windows)

    candidates = counts.filter("words > 1").select("lang", F.col("phrase").cast("string").alias("phrase"), F.col("f").alias("a"))
    split = F.split("phrase", " ")
    longer = candidates.filter(F.size(split) > 2)
    covered = longer.select("lang", F.explode(_sub_phrases(split)).alias("inner"), F.col("a").alias("covers"))
    covered = covered.groupBy(F.col("lang").alias("inner_lang"), "inner").agg(F.max("covers").alias("covers"))
    candidates = candidates.join(covered.hint("merge"), (F.col("lang") == F.col("inner_lang")) & (F.col("phrase") == F.col("inner")), "left")
    kept = candidates.filter(F.col("covers").isNull() | (100 * F.col("covers").cast("decimal(38,0)") < absorbed * F.col("a").cast("decimal(38,0)")))
    kept = stage(kept.select("lang", "phrase", "a"), "candidates", small=True)

    n_words = F.size(split)
    cut = F.explode(F.sequence(F.lit(1), n_words - 1)).alias("before")
    cuts = kept.select("lang", "phrase", "a", split.alias("words"), cut)
    join = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    cuts = cuts.select("lang", "phrase", "a", "before", join(F.lit(1), F.col("before")).alias("left"), join(F.col("before") + 1, F.size("words") - F.col("before")).alias("right"))
    parts = cuts.select("lang", F.explode(F.array("left", "right")).alias("part")).distinct()
    known = stage(look_up(parts.select("lang", F.col("part").cast("binary").alias("phrase")), counts, bounds), "parts", small=True)
    known = known.select("lang", F.col("phrase").cast("string").alias("part"), "f")
    for side, count in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("part").alias(side), F.col("f").alias(count)).hint("merge"), ["lang", side])
    whole = cuts.groupBy("lang", "phrase", "a").agg(F.collect_list(F.struct("before", "l", "r")).alias("cuts")).join(sizes, "lang")

    def score(batches):
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in ("a", "n", "cuts")])
            found = [lowest_cut(a, n, [(x["before"], x["l"], x["r"]) for x in own], scale) for a, n, own in rows]
            columns = [pa.array([x[j] for x in found], pa.int64()) for j in (1, 2, 0)]
            kept = [batch.column(c) for c in ("lang", "phrase", "a", "n")]
            yield pa.RecordBatch.from_arrays([*kept[:3], columns[0], columns[1], kept[3], columns[2]], ["lang", "phrase", "a", "l", "r", "n", "score"])

    scored = whole.mapInArrow(score, "lang string, phrase string, a long, l long, r long, n long, score long")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
