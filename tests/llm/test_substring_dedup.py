import hashlib
import re
from collections import Counter

import pytest

from asterloom.llm.substring_dedup import remove_repeated_windows
from tests.llm.cases import CLASHING, EDGES, colliding_words, documents, prose


def brute(rows, width):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + width]) for w in texts for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, texts):
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(
        ((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in df.collect()),
        key=str,
    )


@pytest.mark.parametrize("seed,width", [(1, 5), (2, 11), (3, 35)])
def test_same_as_brute_force(spark, seed, width):
    rows = prose(seed) + EDGES
    assert found(remove_repeated_windows(documents(spark, rows, CLASHING[:4]), width=width)) == brute(rows, width)


def test_many_chunks(spark, monkeypatch):
    from asterloom.llm import chunks

    monkeypatch.setattr(chunks.chunked, "__defaults__", (300,))
    rows = prose(4) + EDGES
    assert found(remove_repeated_windows(documents(spark, rows), width=8)) == brute(rows, 8)


def test_intervals_are_maximal(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f h"), (3, "p q r")]
    out = {r.doc_id: r.removed for r in remove_repeated_windows(documents(spark, rows), width=3).collect()}
    assert out == {1: [[0, 6]], 2: [[0, 6]], 3: []}


def test_empty_table(spark):
    assert remove_repeated_windows(documents(spark, [])).collect() == []


def test_different_words_stay_apart(spark):
    one, two = colliding_words()
    words = [f"w{i}" for i in range(34)]
    rows = [(1, " ".join([*words, one])), (2, " ".join([*words, two]))]
    assert found(remove_repeated_windows(documents(spark, rows))) == brute(rows, 35)
    assert [r[2] for r in brute(rows, 35)] == [0, 0]


def test_word_hashes():
    import numpy as np

    from asterloom.llm import kernels as k

    texts = [" ".join([*colliding_words(), "x", "y"]), "", "x é漢", "y", "z z"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    starts, ends, _ = k.words(data, np.cumsum([0, *[len(t.encode()) for t in texts]]), k.NOT_SPACE)
    words = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    hashes = k.word_hashes(data, starts, ends, k.NOT_SPACE)
    assert words[2:] == [b"x", b"y", b"x", "é漢".encode(), b"y", b"z", b"z"]
    for column in hashes.T:
        assert [len({h for w, h in zip(words, column) if w == v}) for v in words] == [1] * len(words)
        assert len(set(column.tolist())) == len(set(words))
    assert k.word_hashes(data[:0], starts[:0], ends[:0], k.NOT_SPACE).shape == (0, 2)
