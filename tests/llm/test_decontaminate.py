import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from asterloom.llm import decontaminate as d
from tests.llm.cases import CLASHING, EDGES, colliding_words, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def split(text):
    return WORD.findall("".join(x.lower() if "A" <= x <= "Z" else x for x in text or ""))


def brute(rows, items, width):
    windows = {}
    for item, text in items:
        w = split(text)
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = split(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (x := tuple(w[i : i + n])) in windows:
                    hit.update(range(i, i + n))
                    found.update(str(j) for j in windows[x] if j is not None)
        out.append((doc, len(w), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def items_of(rows, seed):
    rng = random.Random(seed)
    out = [(None, "null id one two"), (900, None), (901, ""), (902, "--- !"), (903, "x"), (904, "x"), (905, "Zz zz")]
    for j in range(25):
        w = split(rng.choice(rows)[1]) or ["q"]
        at = rng.randrange(len(w))
        out.append((j, ", ".join(w[at : at + rng.randint(1, 40)]).upper() + ("!" if j % 2 else " unheard of")))
    return out


def found(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in df.collect()), key=str)


@pytest.mark.parametrize("seed,width,pass_words", [(1, 13, 10**6), (2, 4, 10**6), (3, 13, 30)])
def test_same_as_brute_force(spark, seed, width, pass_words):
    rows = prose(seed) + EDGES
    items = items_of(rows, seed)
    if seed == 1:
        items = [x for x in items if len(split(x[1])) > 9]
    out = d.find_benchmark(documents(spark, rows, CLASHING), spark.createDataFrame(items, ITEM), width=width, pass_words=pass_words)
    assert found(_own(out)) == brute(rows, items, width)


def _own(out):
    """The operator's columns are the last ones; an input column may have the name of one."""
    names = [f"x{i}" for i in range(len(out.columns) - 5)]
    return out.toDF("doc_id", *names[1:], "n_words", "n_hit", "spans", "item_ids", "contaminated")


def test_empty_tables(spark):
    none = spark.createDataFrame([], ITEM)
    assert d.find_benchmark(documents(spark, []), none).collect() == []
    out = d.find_benchmark(documents(spark, EDGES), none).collect()
    assert len(out) == len(EDGES) and not any(r.n_hit or r.contaminated for r in out)


@pytest.mark.parametrize("seed", range(20))
def test_index(seed):
    rng = np.random.default_rng(seed)
    n_symbols = int(rng.integers(2, 9))
    text = rng.integers(1, n_symbols, int(rng.integers(1, 200)))
    index = d.FmIndex(text, n_symbols)
    padded = np.append(text, 0)
    assert [list(padded[i:]) for i in d.suffix_array(padded)] == sorted(list(padded[i:]) for i in range(len(padded)))
    for n in (1, 2, 5):
        phrases = rng.integers(1, n_symbols, (30, n))
        low, high = index.search(phrases)
        for phrase, a, b in zip(phrases, low, high):
            expected = [i for i in range(len(text) - n + 1) if (text[i : i + n] == phrase).all()]
            assert sorted(index.locate(np.arange(a, b))) == expected


def test_occurrences_are_not_multiplied_by_items():
    """A short text of many items that stands in a chunk many times is carried once a place."""
    n_items, n_docs = 300, 200
    hashes, bounds = np.tile(np.array([5, 9], d.k.U), n_docs), np.arange(0, 2 * n_docs + 1, 2)
    phrases = d.Phrases([str(j) for j in range(n_items - 1)] + [None], [np.array([5], d.k.U)] * n_items, 13)
    first, length, phrase = d.occurrences(phrases, hashes, bounds)
    assert len(first) == len(length) == len(phrase) == n_docs
    items = d.merged(bounds, first, length, [d.found_items(phrases, bounds, first, phrase)])[3]
    assert items.to_pylist() == [sorted(str(j) for j in range(n_items - 1))] * n_docs


def test_different_words_stay_apart(spark):
    one, two = colliding_words()
    rows = [(1, one), (2, two)]
    items = spark.createDataFrame([(1, two)], "item_id long, text string")
    out = {r.doc_id: (r.n_hit, r.contaminated) for r in d.find_benchmark(documents(spark, rows), items).collect()}
    assert out == {1: (0, False), 2: (1, True)}
