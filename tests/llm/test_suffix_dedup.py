import random

import numpy as np
import pytest

from asterloom.llm import suffix_dedup as s
from tests.llm.cases import CLASHING, EDGES, documents, prose


def brute(rows, width):
    low = -(2**63)
    texts = [((low if i is None else i), (t or "").encode()) for i, t in rows]
    first = {}
    for i, t in texts:
        for a in range(len(t) - width + 1):
            w = t[a : a + width]
            first[w] = min(first.get(w, i), i)
    out = []
    for (doc, _), (i, t) in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for a in range(len(t) - width + 1):
            if first[t[a : a + width]] < i:
                gone[a : a + width] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((doc, len(t), int(gone.sum()), spans, bytes(np.frombuffer(t, np.uint8)[~gone])))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), bytes(r.kept)) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,width", [(1, 20), (2, 50), (3, 33)])
def test_same_as_brute_force(spark, seed, width):
    rows = prose(seed) + EDGES
    assert found(s.remove_earlier_strings(documents(spark, rows, CLASHING[:4]), width=width)) == brute(rows, width)


def test_many_chunks(spark, monkeypatch):
    from asterloom.llm import chunks

    monkeypatch.setattr(chunks.chunked, "__defaults__", (400,))
    rows = prose(4, 80) + EDGES
    assert found(s.remove_earlier_strings(documents(spark, rows), width=24)) == brute(rows, 24)


@pytest.mark.parametrize("crowd", [2, 5])
def test_crowded_grams_are_dealt_by_window(spark, monkeypatch, crowd):
    from asterloom.llm import chunks

    monkeypatch.setattr(chunks.chunked, "__defaults__", (400,))
    line = "the same long line that stands in very many documents, as it is"
    rows = [(i, f"{t[:150]} {line} {t[100:300]}") for i, t in prose(5, 80)] + EDGES
    assert found(s.remove_earlier_strings(documents(spark, rows), width=24, crowd=crowd)) == brute(rows, 24)


def test_empty_table(spark):
    assert s.remove_earlier_strings(documents(spark, [])).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_two_stage_order(seed):
    rng = random.Random(seed)
    alphabet = rng.choice([b"a", b"ab", b"abcd", bytes(range(256)), b"\x00\xff"])
    text = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 400)))
    if rng.random() < 0.5:
        text = text + text[: len(text) // 2] + text
    depth = rng.choice([8, 12, 50])
    wanted = np.array(sorted(rng.sample(range(len(text)), rng.randint(1, len(text)))))
    padded = np.frombuffer(text + b"\x00\xff" + bytes(depth + 8), np.uint8)
    order = s.two_stage_order(padded, wanted, depth)
    key = lambda i: bytes(padded[i : i + depth])
    assert sorted(order) == list(wanted)
    assert [key(i) for i in order] == sorted(key(i) for i in wanted)
    same = [key(a) == key(b) for a, b in zip(order, order[1:])]
    assert list(s.same_prefix(padded, order, depth)) == same
