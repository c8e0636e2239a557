"""Phrase collocations against a plain count of all phrases, and the automata by themselves."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from asterloom.llm import phrases as p
from tests.llm.cases import DOCUMENT, EDGES

PIECE, WORD = re.compile(r"[.,;:!?\n\x0b\x0c\r]"), re.compile(r"[^ \t]+")
UPPER = {i: i + 32 for i in range(0x41, 0x5B)}


def brute_force(rows, least, longest=5, top=2000, scale=1000, absorbed=100):
    out, langs = [], {"und" if x is None else x for _, x in rows}
    for lang in langs:
        f, n = Counter(), 0
        for text, own in rows:
            if ("und" if own is None else own) == lang:
                for piece in PIECE.split((text or "").translate(UPPER)):
                    w = WORD.findall(piece)
                    n += len(w)
                    f.update(tuple(w[i : i + m]) for m in range(1, longest + 1) for i in range(len(w) - m + 1))
        candidates = {x: a for x, a in f.items() if len(x) > 1 and a >= least}
        found = []
        for x, a in candidates.items():
            inside = lambda y: any(y[i : i + len(x)] == x for i in range(len(y) - len(x) + 1))  # noqa: E731, B023
            if any(len(y) > len(x) and 100 * b >= absorbed * a and inside(y) for y, b in candidates.items()):
                continue
            score, c = min((scale * a * n // (f[x[:c]] * f[x[c:]]), c) for c in range(1, len(x)))
            found.append((-score, -a, " ".join(x).encode(), f[x[:c]], f[x[c:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def table(spark, rows):
    values = [(i, t, lang, None, 0) for i, (t, lang) in enumerate(rows)]
    frame = spark.createDataFrame(values, DOCUMENT)
    return frame.repartition(3) if rows else frame


def found(frame):
    assert frame.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in frame.collect())


def texts(seed, n=60, words=12, longest=80):
    rng = random.Random(seed)
    vocabulary = ["a", "A", "b", "ab", "é", "É", "漢", "b|", "-", "\x00", "\U0001f600", "zz"][:words]
    out = []
    for _ in range(n):
        own = []
        while len(own) < rng.randint(0, longest):
            own += rng.choice([["a", "b", "é"], ["zz"], [rng.choice(vocabulary)]])
        text = "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ","]) for w in own)
        out.append((text, rng.choice(["en", "en", "en", "de", None, "und", ""])))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = texts(seed) * 2
    for options in (dict(least=3), dict(least=6, longest=3, top=7, absorbed=80)):
        small = dict(shard_bytes=300, range_windows=40)
        assert found(p.collocations(table(spark, rows), **options, **small)) == brute_force(rows, **options)


def test_ranges_cut_hot_prefixes(spark):
    """A third of all words are one word, and bounds lie within its phrases."""
    rng = random.Random(9)
    rows = [(" ".join("the" if rng.random() < 0.4 else f"w{rng.randrange(9)}" for _ in range(200)), "en") for _ in range(40)]
    frame = table(spark, rows)
    texts = frame.select("lang", frame.text.cast("binary").alias("text"))
    counts, _, bounds = p.phrase_counts(texts, 5, 5, 2000, 200)
    assert sum(b[1][0] == b"the" for b in bounds) > 3
    expected = Counter()
    for text, _ in rows:
        w = text.encode().split()
        expected.update(b" ".join(w[i : i + m]) for m in range(1, 6) for i in range(len(w) - m + 1))
    got = {bytes(r.phrase): r.f for r in counts.collect()}
    assert got == {x: n for x, n in expected.items() if n >= 5}
    assert found(p.collocations(frame, least=20, shard_bytes=2000, range_windows=200)) == brute_force(rows, 20)


def test_builder_gives_the_smallest_automaton():
    phrases = [((b"a",), 2), ((b"a", b"x"), 1), ((b"a", b"y"), 1), ((b"b",), 2), ((b"b", b"x"), 1), ((b"b", b"y"), 1), ((b"c",), 5)]
    automaton = p.of_phrases(phrases)
    assert list(automaton.paths()) == phrases
    assert len(automaton.weights) == 4  # a leaf of weight 1, the state of a and b, that of c, the beginning
    again = p.Automaton.unpack(__import__("pyarrow").scalar(automaton.pack()))
    assert list(again.paths()) == phrases and again.words == automaton.words
    assert list(p.of_phrases([]).paths()) == []


def test_union_and_composition():
    rng = random.Random(2)
    automata, total = [], Counter()
    for _ in range(5):
        windows = sorted({tuple(rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 4))) for _ in range(20)})
        own = Counter()
        for w in windows:
            own.update(w[:m] for m in range(1, len(w) + 1))
        total += own
        automata.append(p.of_phrases(sorted(own.items())))
    assert sorted(p.union(automata, 4)) == sorted((x, n) for x, n in total.items() if n >= 4)
    edge = min(total, key=lambda x: (total[x], x))
    assert set(p.union(automata, 10**6, [edge])) == {(edge[:m], total[edge[:m]]) for m in range(1, len(edge) + 1)}
    asked = [(b"a",), (b"a", b"zz"), (b"b", b"b"), (b"zz",)]
    counts = p.of_phrases(sorted(total.items()))
    assert dict(p.compose(p.of_phrases([(x, 1) for x in asked]), counts)) == {x: total[x] for x in asked if x in total}


def test_scores_are_exact_beyond_64_bits():
    a, n = 2**60 + 1, 2**62 + 3
    assert p.lowest_cut(a, n, [(1, a, a), (2, a, a + 1)], 10**40) == (10**40 * n // (a + 1), a, a + 1)
    assert p.lowest_cut(a, n, [(2, a, a + 1), (1, a, a)], 1000) == (3999, a, a)
    assert p.lowest_cut(5, 7, [(2, 10, 10), (1, 10, 10)], 1000)[1:] == (10, 10)


def test_long_text_is_cut_where_pieces_end(spark):
    text = b"one two three. " * 2_000_000
    parts = p.cut_long(text, 4_000_000)
    assert b"".join(parts) == text and all(len(x) < 4_000_020 and x.endswith(b".") for x in parts[:-1])
    assert p.cut_long(b"x" * 50, 10) == [b"x" * 50]
    got = found(p.collocations(table(spark, [(text.decode(), "en")])))
    assert got == [("en", 1, "one two three", 2_000_000, 2_000_000, 2_000_000, 6_000_000, 3000)]


def test_edges(spark):
    rows = [(t, None) for _, t in EDGES]
    assert found(p.collocations(table(spark, rows), least=2)) == brute_force(rows, 2)
    assert found(p.collocations(table(spark, []))) == []
    assert found(p.collocations(table(spark, [(None, None), ("", "en"), (" . \n", "en")]), least=1)) == []


def test_one_hash_for_all_changes_nothing(spark, monkeypatch):
    """Hashes only leave out what cannot be frequent: if all collide, nothing is left out."""
    rows = texts(4, n=30)
    words = p.Words("en", np.frombuffer(b"a b c", np.uint8), np.array([0, 5]))
    often, following = words.runs(lambda h: np.ones(len(h), bool), 5)
    assert often.all() and following.tolist() == [2, 1, 0]
    monkeypatch.setattr(p, "BITS_EACH", 0)
    monkeypatch.setattr(p, "LEAST_BITS", 64)
    assert found(p.collocations(table(spark, rows), least=3)) == brute_force(rows, 3)
