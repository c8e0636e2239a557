import hashlib

import numpy as np
import pyarrow as pa
import pytest

from asterloom.llm import digest as d
from tests.llm.cases import CLASHING, EDGES, documents, prose


def counts_of(text):
    b = text.encode()
    out = [0] * d.BUCKETS
    for kind, (j, k) in enumerate(d.TRIPLETS):
        for i in range(len(b) - k):
            h = b[i] * 0x9E3779B1 + b[i + j] * 0x85EBCA77 + b[i + k] * 0xC2B2AE3D + kind * 0x27D4EB2F
            h &= 0xFFFFFFFF
            h ^= h >> 15
            out[(h * 0x2C1B3C6D & 0xFFFFFFFF) >> 25] += 1
    return out


def hex_of(text):
    return d.encode(np.array([counts_of(text)]), np.array([len(text.encode())]))[0].tobytes().hex()


def brute(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    out = []
    for j, (i, t) in enumerate(rows):
        after = rows[(j + 1) % len(rows)][1]
        edited = t[: len(t) - len(t) // 2] + after[: len(t) // 2]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), hex_of(t), hex_of(edited)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    rows = prose(seed) + EDGES
    out = d.edited_fingerprints(documents(spark, rows, CLASHING)).collect()
    assert sorted((tuple(r)[:5] for r in out), key=str) == brute(rows)
    assert all(0 <= x <= 1 for r in out for x in (r.near_edited, r.near_next))


def test_more_blocks_than_quantiles(spark, monkeypatch):
    monkeypatch.setattr(d, "QUANTILES", 7)
    rows = prose(6) + EDGES
    out = d.edited_fingerprints(documents(spark, rows)).collect()
    assert sorted((tuple(r)[:5] for r in out), key=str) == brute(rows)


def test_one_and_no_document(spark):
    assert d.edited_fingerprints(documents(spark, [])).collect() == []
    (row,) = d.edited_fingerprints(documents(spark, [(4, "abcdef")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and row.near_next == 1


def test_likeness_orders_edits(spark):
    rows = [(i, t) for i, t in prose(3, 80, longest=600) if len(t) > 500]
    out = d.edited_fingerprints(documents(spark, rows)).collect()
    nearer = [r.near_edited > r.near_next for r in out if r.near_next < 1]
    assert sum(nearer) > 0.9 * len(nearer)


def test_fingerprints_and_compare(spark):
    rows = [(1, "same text here"), (2, "same text here"), (3, None), (4, "")]
    found = d.fingerprints(documents(spark, rows, CLASHING[:2]))
    by_id = {r.doc_id: r.fingerprint for r in found.collect()}
    assert by_id[1] == by_id[2] != by_id[3] == by_id[4]
    pairs = spark.createDataFrame([(by_id[1], by_id[2]), (by_id[1], by_id[3]), (by_id[1], None)], "a string, b string")
    like = [r.likeness for r in d.compare(pairs, "a", "b").collect()]
    assert like[0] == 1 and 0 <= like[1] < 1 and like[2] is None


def test_batches_do_not_matter():
    texts = pa.array([t for _, t in prose(5)] + [None, "", "ab", "漢" * 100000])
    whole = d.digests(texts)
    assert all((d.digests(texts.slice(i, 1))[0] == whole[i]).all() for i in range(len(texts)))
