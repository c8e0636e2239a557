import numpy as np
import pyarrow as pa
import pytest

from asterloom.llm import chunks as c
from tests.llm.cases import documents


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16, 1 << 20])
def test_distinct_values_by_bucket(buckets):
    rng = np.random.default_rng(buckets)
    values = rng.integers(0, 2**63, 300, dtype=np.uint64)[rng.integers(0, 300, 2000)]
    at = (values % np.uint64(buckets)).astype(np.int64)
    order, once, own, n = c.distinct_in_buckets(values, at, buckets, np.uint64)
    expected = sorted(set(zip(at.tolist(), values.tolist())))
    assert list(zip(own.tolist(), once.tolist())) == expected
    assert n.tolist() == [int((values == v).sum()) for _, v in expected]
    assert (values[order] == np.repeat(once, n)).all()
    none = c.distinct_in_buckets(values[:0], at[:0], buckets, np.uint64)
    assert [len(x) for x in none] == [0, 0, 0, 0]


def test_bits_of_slices():
    rng = np.random.default_rng(3)
    sizes = np.array([1, 8, 0, 9, 30, 3])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    bits = rng.random(bounds[-1]) < 0.5
    take = np.array([True, True, False, False, True, True])
    valid = np.array([True, False, True, True, True, True])
    out = c.packed_bits(bits, bounds, take, valid)
    expected = [np.packbits(bits[a:b]).tobytes() if v else None for a, b, t, v in zip(bounds[:-1], bounds[1:], take, valid) if t]
    assert out.to_pylist() == expected
    values, ends = c.joined(pa.chunked_array([c.slices(np.arange(5, dtype=np.int64), np.array([0, 2, 2, 5]))]), np.int64)
    assert values.tolist() == [0, 1, 2, 3, 4] and ends.tolist() == [0, 2, 2, 5]


@pytest.mark.parametrize("buckets", [3, 1 << 18])
@pytest.mark.parametrize("copies", [1, 4])
def test_answers_do_not_depend_on_the_buckets(spark, buckets, copies):
    """With more buckets than hashes there is a message for each distinct hash of a chunk, at most."""
    texts = [(i, " ".join(f"w{(i * 7 + j) % 97}" for j in range(20)) + f" own{i}") for i in range(60 * copies)]
    chunks = c.stage(c.chunked(documents(spark, texts).select("doc_id", "text"), "text", 300), "test")

    def hashes(chunk):
        words = [w for i in range(len(chunk.lengths)) for w in chunk.text(i).split()]
        values = np.array([hash_of(w) for w in words], np.uint64)
        return values, (values % np.uint64(buckets)).astype(np.int64)

    def hash_of(word):
        return int.from_bytes(word.ljust(8, b"_")[:8], "little")

    marks = {r.chunk: r.marks for r in c.repeated(chunks, hashes, buckets).collect()}
    everywhere = {}
    for row in chunks.select("chunk", "lengths", "text").collect():
        for word in set(row_words(row)):
            everywhere.setdefault(word, set()).add(row.chunk)
    for row in chunks.select("chunk", "lengths", "text").collect():
        words = set(row_words(row))
        shared = {hash_of(w) for w in words if len(everywhere[w]) > 1}
        told = set()
        for m in marks.get(row.chunk) or []:
            own = sorted(hash_of(w) for w in words if hash_of(w) % buckets == m.bucket)
            bits = np.unpackbits(np.frombuffer(m.bits, np.uint8), count=len(own))
            told |= {h for h, b in zip(own, bits) if b}
        assert told == shared
        assert len(marks.get(row.chunk) or []) <= len(words)


def row_words(row):
    data = c.unsqueeze(pa.scalar(bytes(row.text), pa.binary())).tobytes()
    ends = np.cumsum(row.lengths)
    return [w for a, b in zip(ends - row.lengths, ends) for w in data[a:b].split()]
