import random
import re

import pytest
import xxhash

from asterloom.llm import components as cc
from asterloom.llm import simhash as s
from asterloom.llm.chunks import stage  # noqa: F401
from tests.llm.cases import CLASHING, EDGES, documents, prose


def print_of(text, n=3):
    low = "".join(x.lower() if "A" <= x <= "Z" else x for x in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    h = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(nodes, linked):
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


def brute(rows, radius):
    prints = [print_of(t) for _, t in rows]
    n = range(len(rows))
    root = groups(n, [(i, j) for i in n for j in n if i < j and (prints[i] ^ prints[j]).bit_count() <= radius])
    out = []
    for i in n:
        ids = [rows[j][0] for j in n if root[j] == root[i] and rows[j][0] is not None]
        out.append((rows[i][0], f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


@pytest.mark.parametrize("seed,radius", [(1, 2), (2, 9)])
def test_same_as_brute_force(spark, seed, radius):
    rows = prose(seed, 90, vocabulary=60, longest=200) + EDGES
    out = s.near_duplicates(documents(spark, rows, CLASHING), radius=radius)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in out.collect()), key=str) == brute(rows, radius)


def test_empty_table(spark):
    assert s.near_duplicates(documents(spark, [])).collect() == []


@pytest.mark.parametrize("tile", [3, 4096])
def test_links_connect_all_within_radius(spark, tile):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for x in list(prints):
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
            if rng.random() < 0.7:
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    signed = [x - 2**64 if x >> 63 else x for x in prints]
    frame = spark.createDataFrame([(x,) for x in signed], "fingerprint long")
    found = [(r.a, r.b) for r in s.links(frame, 2, tile=tile).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in found)
    pairs = [(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2]
    assert groups(signed, found) == groups(signed, pairs)


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(i, i + 1) for i in range(100, 130)] + [(5, 5)]
    nodes = {x for a, b in edges for x in (a, b) if a != b}
    found = {r.node: r.root for r in cc.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == groups(nodes, [e for e in edges if e[0] != e[1]])
