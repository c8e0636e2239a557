"""Exact substring removal by bytes: what an earlier document has, too, goes.

Strings of a fixed number of bytes that two documents share are found with suffix arrays. A
suffix array of the whole corpus does not fit one task, so candidate stretches are dealt to
shards by content: the smallest hash of the 16-byte grams in a window is the same wherever the
window's string stands, so all its occurrences meet in one shard. Each shard sorts its suffixes
in two stages and compares neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm import chunks as c
from asterloom.llm import kernels as k

WINDOW_BYTES = 50
#: Bytes of candidate stretches in a shard, about, if a quarter of the corpus repeats.
SHARD_BYTES = 1_500_000
#: Stretches around one gram from which its windows are dealt by their own content instead.
CROWD = 200_000
BLOCK = 1 << 17
#: Bytes of messages that a chunk makes at a time; and bytes from which the text of one is compressed by itself.
PIECE_BYTES, SQUEEZED_BYTES = 4 << 20, 512


def words64(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a number."""
    if len(data) < 8:
        return np.zeros(0, k.U)
    return np.array(np.ndarray((len(data) - 7,), "<u8", buffer=np.ascontiguousarray(data), strides=(1,)))


def smallest_grams(data: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` bytes the smallest hash of its grams."""
    gram = 16 if width >= 32 else 8
    span = width - gram + 1
    out = np.zeros(max(0, len(data) - width + 1), k.U)
    for at in range(0, len(out), BLOCK):
        w = words64(data[at : at + BLOCK + width - 1])
        h = w * k.U(0x9FB21C651E98DF25)
        h ^= h >> k.U(32)
        if gram == 16:
            h = h[:-8] + w[8:] * k.U(0xD6E8FEB86659FD93)
        h *= k.U(0xA24BAED4963EE407)
        h ^= h >> k.U(29)
        h *= k.U(0x9FB21C651E98DF25)
        reach = 1
        while reach * 2 <= span:
            h = np.minimum(h[:-reach], h[reach:])
            reach *= 2
        if span > reach:
            h = np.minimum(h[: reach - span], h[span - reach :])
        out[at : at + len(h)] = h
    return out


def stretches(chunk: c.Chunk, width: int):
    """Runs of neighbouring windows with the same smallest gram: first window, count, gram hash."""
    smallest = smallest_grams(chunk.data, width)
    n = len(smallest)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), smallest
    counts = np.diff(chunk.offsets) - width + 1
    long = counts > 0
    edge = np.zeros(len(chunk.data) + 1, np.int8)
    edge[chunk.offsets[:-1][long]] += 1
    edge[(chunk.offsets[:-1] + counts)[long]] -= 1
    valid = np.cumsum(edge[:n], dtype=np.int8).astype(bool)
    change = smallest[1:] != smallest[:-1]
    first, last = valid.copy(), valid.copy()
    first[1:] &= change | ~valid[:-1]
    last[:-1] &= change | ~valid[1:]
    firsts = np.flatnonzero(first)
    return firsts, np.flatnonzero(last) + 1 - firsts, smallest[firsts]


def gram_hashes(chunk: c.Chunk, width: int, buckets: int):
    _, _, grams = stretches(chunk, width)
    return k.mix(grams) >> k.U(32), (k.mix(grams, 1) % k.U(buckets)).astype(np.int64)


class Candidates:
    """The stretches of a chunk whose gram stands elsewhere, equal ones listed once by shard.

    Around a gram that very many stretches share, each window is a stretch of its own, dealt by
    its content, so that no shard gets all texts around a frequent passage.
    """

    def __init__(self, chunk: c.Chunk, width: int, buckets: int, shards: int, marks, key: str):
        starts, counts, grams = stretches(chunk, width)
        values, at = k.mix(grams) >> k.U(32), (k.mix(grams, 1) % k.U(buckets)).astype(np.int64)
        again = c.is_repeated(values, at, buckets, marks, np.uint32)
        crowded = c.is_crowded(values, at, buckets, marks, np.uint32)
        roll = k.Rolling(k.BYTE_VALUES[chunk.data])
        single = k.ranges(starts[crowded], counts[crowded])
        again &= ~crowded
        self.starts = np.concatenate([starts[again], single])
        self.counts = np.concatenate([counts[again], np.ones(len(single), np.int64)])
        grams = np.concatenate([grams[again], k.mix(roll(single, single + width), 5)])
        self.ids = chunk.keys(key)[np.searchsorted(chunk.offsets, self.starts, "right") - 1]
        lengths = self.counts + width - 1
        content = k.mix(roll(self.starts, self.starts + lengths) + lengths.astype(k.U))
        order = np.argsort(content, kind="stable")
        ordered = content[order]
        new = np.ones(len(order), bool)
        new[1:] = ordered[1:] != ordered[:-1]
        heads = np.flatnonzero(new)
        chosen = order[heads]
        smallest_id = np.minimum.reduceat(self.ids[order], heads) if len(heads) else self.ids[:0]
        shard_order, self.bounds = c.cut((k.mix(grams[chosen], 3) % k.U(shards)).astype(np.int64), shards)
        self.first, self.n, self.min_id = chosen[shard_order], self.counts[chosen[shard_order]], smallest_id[shard_order]
        place = np.empty(len(heads), np.int64)
        place[shard_order] = np.arange(len(heads))
        self.unique = np.empty(len(order), np.int64)
        self.unique[order] = place[np.cumsum(new) - 1]


def prefix_order(text: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the next ``depth`` bytes; those that agree keep their order."""
    m = len(at)
    if m < 2:
        return at
    present = np.flatnonzero(np.bincount(text, minlength=256))
    code = np.zeros(256, k.U)
    code[present] = np.arange(len(present), dtype=k.U)
    bits = max(1, int(len(present) - 1).bit_length())
    low = int(m - 1).bit_length()
    order, done = np.arange(m), 0
    open_at, group, groups = np.arange(m), np.zeros(m, k.U), 1
    while done < depth:
        free = 64 - low - int(groups - 1).bit_length()
        take = min(free // bits, depth - done)
        own = at[order[open_at]] + done
        value = group.copy()
        for j in range(take):
            value <<= k.U(bits)
            value |= code[text[own + j]]
        key = np.sort((value << k.U(low)) | order[open_at].astype(k.U))
        order[open_at] = (key & k.U((1 << low) - 1)).astype(np.int64)
        key >>= k.U(low)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        done += take
        alone = new.copy()
        alone[:-1] &= new[1:]
        left = ~alone
        if not left.any():
            break
        open_at = open_at[left]
        group = np.cumsum(new[left]).astype(k.U) - k.U(1)
        groups = int(group[-1]) + 1
    return at[order]


def two_stage_order(text: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The wanted suffixes in order of their first ``depth`` bytes, or more.

    Suffixes smaller than their successors are sorted directly. Scanning the buckets of first
    bytes from left to right then puts each larger one in its place, as the order of its
    successor is known by that time. Besides the wanted suffixes only those are placed that the
    scan needs to reach them. ``text`` must end in ``depth`` + 2 bytes that no wanted suffix
    starts in: a 0, a 255, and any others.
    """
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = np.zeros(len(text), bool)
    rises[: change[-1] + 1] = np.repeat(text[change] < text[change + 1], np.diff(change, prepend=-1))
    inside = np.zeros(len(text), bool)
    inside[wanted] = True
    falling_end = np.flatnonzero(inside[:-1] & ~inside[1:] & ~rises[:-1])
    risers = np.flatnonzero(rises)
    reach = risers[np.searchsorted(risers, falling_end)]
    inside[k.ranges(falling_end + 1, reach - falling_end)] = True

    direct = prefix_order(text, np.flatnonzero(inside & rises), depth)
    induced = inside & ~rises
    n_induced = np.bincount(text[induced], minlength=256)
    n_direct = np.bincount(text[direct], minlength=256)
    ends = np.cumsum(n_induced + n_direct)
    head = ends - n_induced - n_direct
    middle = head + n_induced
    order = np.empty(ends[-1], np.int64)
    order[np.arange(len(direct)) + np.cumsum(n_induced)[text[direct]]] = direct

    def put(block):
        before = block - 1
        before = before[before >= 0]
        before = before[induced[before]]
        byte = text[before]
        by_byte = np.argsort(byte, kind="stable")
        before, byte = before[by_byte], byte[by_byte]
        counts = np.bincount(byte, minlength=256)
        order[(head - np.cumsum(counts) + counts)[byte] + np.arange(len(byte))] = before
        head[:] += counts

    for byte in np.flatnonzero(n_induced + n_direct):
        at = middle[byte] - n_induced[byte]
        while at < head[byte]:
            upto = head[byte]
            put(order[at:upto])
            at = upto
        put(order[middle[byte] : ends[byte]])
    keep = np.zeros(len(text), bool)
    keep[wanted] = True
    return order[keep[order]]


def same_prefix(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix but the first has ``depth`` bytes in common with the one before it."""
    words = words64(text)
    same = np.ones(max(0, len(order) - 1), bool)
    for at in [*range(0, depth - 7, 8), depth - 8]:
        w = words[order + at]
        same &= w[1:] == w[:-1]
    return same


def first_documents(text: np.ndarray, lengths: np.ndarray, ids: np.ndarray, width: int):
    """Windows that another stretch has, too, with a smaller id: stretch, offset, length, id.

    The text is that of the stretches in a row; ``ids`` is the smallest document of each.
    """
    counts = lengths - width + 1
    starts = np.cumsum(lengths) - lengths
    wanted = k.ranges(starts, counts)
    owner = np.repeat(np.arange(len(lengths)), counts)
    padded = np.concatenate([text, np.array([0, 255] + [0] * (width + 8), np.uint8)])
    order = two_stage_order(padded, wanted, width)
    same = same_prefix(padded, order, width)
    slot = np.zeros(len(padded), np.int64)
    slot[wanted] = np.arange(len(wanted))
    order = slot[order]
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    smallest = np.minimum.reduceat(ids[owner[order]], heads)
    found = np.empty(len(order), np.int64)
    found[order] = np.repeat(smallest, np.diff(np.append(heads, len(order))))
    better = found < ids[owner]
    new = better.copy()
    new[1:] &= ~better[:-1] | (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    last = better.copy()
    last[:-1] &= ~better[1:] | (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    a, b = np.flatnonzero(new), np.flatnonzero(last) + 1
    first_window = np.cumsum(counts) - counts
    return owner[a], a - first_window[owner[a]], b - a, found[a]


def without_torn_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """What is gone, and the other bytes of characters of which a part is gone."""
    if len(data) == 0:
        return gone
    begins = np.flatnonzero((data & 0xC0) != 0x80)
    return np.repeat(np.logical_or.reduceat(gone, begins), np.diff(np.append(begins, len(data))))


def remove_earlier_strings(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WINDOW_BYTES,
    shard_bytes: int = SHARD_BYTES,
    whole_characters: bool = False,
    crowd: int = CROWD,
) -> DataFrame:
    """The documents without the bytes in strings that also start in a document with a smaller id.

    A text is its UTF-8 bytes; strings are ``width`` (at least 12) of them, do not cross documents
    and are judged on the input. Added columns: ``n_bytes``, ``n_removed``, ``removed`` (maximal
    removed runs, ``[first, end)``) and ``kept`` (the other bytes, which may hold parts of
    characters; with ``whole_characters`` such parts are left out of ``kept``, too). Null and empty texts have no bytes. A null id counts as smaller than any other;
    rows with the same id do not count as earlier, so repeated rows keep their text. An empty
    table gives an empty table.

    A chunk sends equal stretches once, with the smallest id that has them, so a text that stands
    in a third of all documents costs its shard one copy per chunk. Different texts around one
    passage that ``crowd`` stretches or more share are dealt to many shards.
    """
    total = c.text_bytes(docs, text)
    buckets = max(48, total // (18 * 1_500_000) + 1)
    shards = max(48, total // shard_bytes + 1)
    frame, names = c.by_position(docs)
    here, key_column = f"c{names.index(text)}", f"c{names.index(key)}"
    chunks = c.write_chunks(frame, here)
    marks = c.repeated(chunks, lambda chunk: gram_hashes(chunk, width, buckets), buckets, np.uint32, crowd)
    marked = c.with_marks(chunks, marks)

    def send(batches):
        for chunk, batch, i in c.each(batches):
            own = Candidates(chunk, width, buckets, shards, batch.column("marks")[i], key_column)
            lengths = own.n + width - 1
            upto = np.concatenate([[0], np.cumsum(lengths)])
            full = np.flatnonzero(own.bounds[1:] > own.bounds[:-1])
            # Some messages at a time: those of a whole chunk can have many times its bytes.
            piece = (upto[own.bounds[full + 1]] - 1) // PIECE_BYTES
            for some in np.split(full, np.flatnonzero(np.diff(piece)) + 1) if len(full) else []:
                ends = np.append(own.bounds[some], own.bounds[some[-1] + 1])
                part = slice(ends[0], ends[-1])
                data = chunk.data[k.ranges(own.starts[own.first[part]], lengths[part])]
                ends_of_text = upto[ends] - upto[ends[0]]
                sizes = np.diff(ends_of_text)
                long = sizes >= SQUEEZED_BYTES
                plain = np.concatenate([[0], np.cumsum(np.where(long, 0, sizes))])
                squeezed = [c.squeeze(data[ends_of_text[j] : ends_of_text[j + 1]]) for j in np.flatnonzero(long)]
                columns = [
                    pa.array(some, pa.int32()),
                    pa.array(np.full(len(some), chunk.id), pa.int64()),
                    c.slices(data[np.repeat(~long, sizes)], plain),
                    pa.array(squeezed, pa.binary()).take(pa.array(np.cumsum(long) - 1, mask=~long)),
                    c.slices(lengths[part].astype(np.int32), ends - ends[0]),
                    c.slices(own.min_id[part], ends - ends[0]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["shard", "chunk", "text", "squeezed", "lengths", "ids"])

    def solve(table: pa.Table) -> pa.Table:
        lengths, before = c.joined(table.column("lengths"), np.int32)
        lengths = lengths.astype(np.int64)
        ids, _ = c.joined(table.column("ids"), np.int64)
        ends = np.concatenate([[0], np.cumsum(lengths)])[before]
        text = np.empty(ends[-1], np.uint8)
        squeezed = table.column("squeezed").combine_chunks()
        plain = squeezed.is_null().to_numpy(zero_copy_only=False)
        text[k.ranges(ends[:-1][plain], np.diff(ends)[plain])] = c.joined(table.column("text"), np.uint8)[0]
        for r in np.flatnonzero(~plain):
            text[ends[r] : ends[r + 1]] = c.unsqueeze(squeezed[r])
        owner, offset, length, smallest = first_documents(text, lengths, ids, width)
        row = np.searchsorted(before, owner, "right") - 1
        bounds = np.searchsorted(row, np.arange(len(before)))
        some = np.flatnonzero(bounds[1:] > bounds[:-1])
        out = table.select(["chunk", "shard"]).take(pa.array(some))
        found = np.stack([owner - before[row], offset, length, smallest], 1).astype(np.int64).ravel()
        k.release_memory()
        return out.append_column("found", c.slices(found, 4 * np.append(bounds[some], len(row))))

    requests = marked.mapInArrow(send, "shard int, chunk long, text binary, squeezed binary, lengths binary, ids binary")
    answers = c.stage(requests.groupBy("shard").applyInArrow(solve, "chunk long, shard int, found binary"), "suffixes", small=True)
    answers = answers.groupBy("chunk").agg(F.collect_list(F.struct("shard", "found")).alias("answers"))

    def apply(chunk, batch, i):
        own = Candidates(chunk, width, buckets, shards, batch.column("marks")[i], key_column)
        offsets = np.cumsum(own.n) - own.n
        smallest = np.repeat(own.min_id, own.n)
        answer = batch.column("answers")[i]
        if answer.is_valid:
            found, bounds = c.joined(answer.values.field("found"), np.int64)
            which, offset, length, ids = found.reshape(-1, 4).T
            which = which + np.repeat(own.bounds[answer.values.field("shard").to_numpy()], np.diff(bounds) // 4)
            smallest[k.ranges(offsets[which] + offset, length)] = np.repeat(ids, length)
        at = k.ranges(own.starts, own.counts)
        hit = smallest[k.ranges(offsets[own.unique], own.counts)] < np.repeat(own.ids, own.counts)
        gone = k.covered(len(chunk.data), at[hit], width)
        firsts, lasts = k.runs(gone, chunk.offsets)
        by_doc = np.searchsorted(firsts, chunk.offsets)
        n_removed = k.sums_between(gone, chunk.offsets)
        if whole_characters:
            gone = without_torn_characters(chunk.data, gone)
        left = np.concatenate([[0], np.cumsum(~gone)])
        kept = c.binary_array(chunk.data[~gone], left[chunk.offsets])
        lists = np.stack([firsts, lasts], 1) - chunk.offsets[np.searchsorted(chunk.offsets, firsts, "right") - 1][:, None]
        pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(lists) + 1, 2), pa.int32()), pa.array(lists.ravel(), pa.int64()))
        return [
            pa.array(np.diff(chunk.offsets)),
            pa.array(n_removed),
            pa.ListArray.from_arrays(pa.array(by_doc, pa.int32()), pairs),
            kept,
        ]

    out = c.unpack(
        c.with_marks(marked, answers),
        apply,
        [
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("kept", T.BinaryType()),
        ],
    )
    return out.toDF(*[n for n in names if n != text], "n_bytes", "n_removed", "removed", "kept")
