"""The inverted multi-index against a comparison of all pairs."""

import time

import numpy as np
import pytest

from asterloom.llm import multi_index as m

SCHEMA = "vec_id long, embedding array<double>, label string"


def brute_force(vectors, every=50, neighbours=5):
    """``{query: [(score, id)]}`` over ``{id: vector}``."""
    ids = sorted(vectors)
    table = np.array([vectors[i] for i in ids], np.float64)
    length = np.sqrt((table * table).sum(axis=1))
    out = {}
    for i in ids:
        if i % every == 0:
            q = np.asarray(vectors[i], np.float64)
            score = (table * q).sum(axis=1) / (length * np.sqrt((q * q).sum()))
            out[i] = sorted((-s, j) for s, j in zip(score.tolist(), ids) if j != i)[:neighbours]
    return {i: [(-s, j) for s, j in found] for i, found in out.items()}


def found(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        own = out.setdefault(r.query_id, [])
        own.append((r.score, r.vec_id))
        assert r["rank"] == len(own)
    return out


def table(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], SCHEMA).repartition(3)


def close(got, expected):
    assert got.keys() == expected.keys()
    for i in expected:
        assert [j for _, j in got[i]] == [j for _, j in expected[i]]
        assert np.allclose([s for s, _ in got[i]], [s for s, _ in expected[i]], rtol=0, atol=1e-12)


def test_walk_is_in_order_and_complete():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a, b = rng.random(rng.integers(1, 9)), rng.random(rng.integers(1, 9))
        sizes = rng.integers(0, 4, (len(a), len(b)))
        order = np.argsort((a[:, None] + b).ravel(), kind="stable")
        full = [c for c in order.tolist() if sizes.ravel()[c]]
        assert m.walk(a, b, sizes.tolist(), 10**9) == full
        part = m.walk(a, b, sizes.tolist(), 5)
        assert part == full[: len(part)]
        assert sizes.sum() < 5 or sizes.ravel()[part].sum() >= 5 and sizes.ravel()[part[:-1]].sum() < 5


def test_selection_is_the_walk():
    """With sums that are equal, of which the walk takes some only, and cells without entries."""
    rng = np.random.default_rng(4)
    for at in range(200):
        a, b = rng.integers(0, 4, rng.integers(1, 30)) / 2.0, rng.integers(0, 4, rng.integers(1, 30)) / 2.0
        a, b = (a, b) if at % 2 else (a + rng.random(len(a)), b + rng.random(len(b)))
        sizes = rng.integers(0, 4, (len(a), len(b)))
        for wanted in (1, 7, int(sizes.sum()) // 2 + 1, int(sizes.sum()) + 1):
            expected = np.zeros(sizes.size, bool)
            expected[m.walk(a, b, sizes.tolist(), wanted)] = True
            assert (m.select(a, b, sizes.ravel(), wanted) == expected).all()


def test_a_long_walk_takes_no_step_per_cell():
    rng = np.random.default_rng(6)
    distances, sizes = rng.random((12, 2, 256)), rng.integers(0, 9, (256, 256))
    wanted, cells = int(sizes.sum()) // 3, sizes.tolist()
    took = []
    for way in (lambda a, b: m.select(a, b, sizes.ravel(), wanted), lambda a, b: m.walk(a, b, cells, wanted)):
        began = time.process_time()
        for a, b in distances:
            way(a, b)
        took.append(time.process_time() - began)
    assert took[0] < took[1] / 3


def test_blocks_travel_in_groups():
    sizes = np.random.default_rng(8).integers(0, 30, 5000)
    sizes[[7, 70]] = 90, 1000
    blocks = m.Blocks.of(sizes, 20)
    group = blocks.groups(5000)
    cells = blocks.cells_by_group(group)
    assert (np.diff(group) >= 0).all() and sorted(cells) == list(range(len(cells)))
    assert len(cells) <= sizes.sum() / 5000 + 2
    for cell in np.flatnonzero(sizes):
        own = {int(group[blocks.first[cell] + part]) for part in range(blocks.parts[cell])}
        assert own == {g for g, c in cells.items() if cell in c}


def grouped(rng, n, cells, kind=np.float32, keys=None):
    """A group of vectors in cells, in three pieces, and its rows: vector, cell and keys."""
    vectors = rng.normal(size=(n, 6)).astype(kind)
    vectors[n // 2 : n // 2 + n // 4] = vectors[0] * (1 + np.arange(n // 4)[:, None] % 5) + rng.normal(scale=1e-9, size=(n // 4, 6)).astype(kind)
    where = rng.integers(0, len(cells), n)
    ids = [[10 * i, 10 * i + 1][: 1 + i % 2] if keys is None else [int(rng.integers(keys))] for i in range(n)]
    group = m.Group(cells, np.dtype(kind), 6, n // 2)
    for some in np.array_split(rng.permutation(n), 3):
        counts = np.array([len(ids[i]) for i in some], np.int32)
        group.add(vectors[some], cells[where[some]].astype(np.int32), counts, np.array([x for i in some for x in ids[i]]))
    return group.close(), vectors, where, ids


@pytest.mark.parametrize("kind, keys", [(np.float32, None), (np.float64, None), (np.float32, 40), (np.float32, 4)])
def test_ranking_is_exact_within_the_cells_passed(monkeypatch, kind, keys):
    """Many equal directions, vectors that single precision cannot tell apart, and keys with several vectors."""
    monkeypatch.setattr(m, "LEAST_STRIP", 16)
    monkeypatch.setattr(m, "STRIP", 50)
    monkeypatch.setattr(m, "COMPARED", 700)
    monkeypatch.setattr(m, "POOL", 3)
    rng = np.random.default_rng(9)
    group, vectors, where, ids = grouped(rng, 900, np.array([3, 5, 8, 9, 40]), kind, keys)
    queries, own = np.concatenate([vectors[:20], vectors[450:470]]), np.array([ids[i][0] for i in [*range(20), *range(450, 470)]])
    passed = rng.random((5, 40)) < 0.6
    passed[:, 7] = False
    found = {q: [] for q in range(40)}
    for q, i, s in zip(*m.Ranking(queries, own, np.packbits(passed, axis=1), group, 5).run()):
        found[q].append((s, i))
    for q in range(40):
        table, mine = m.scaled(vectors), m.scaled(queries)[q]
        score = (table * mine).sum(axis=1) / (m.norms(table) * np.sqrt((mine * mine).sum()))
        best = {}
        for s, i in sorted((-s, i) for at, s in enumerate(score.tolist()) if passed[where[at], q] for i in ids[at]):
            best.setdefault(i, -s)
        best.pop(int(own[q]), None)
        assert found[q] == [(s, i) for i, s in best.items()][:5]


def test_only_entries_of_cells_passed_are_compared(monkeypatch):
    compared = []
    product = np.matmul
    monkeypatch.setattr(np, "matmul", lambda a, b, **x: compared.append(len(a) * b.shape[1]) or product(a, b, **x))
    rng = np.random.default_rng(10)
    group, _, where, _ = grouped(rng, 20_000, np.arange(40))
    passed = rng.random((40, 300)) < 0.05
    m.Ranking(rng.normal(size=(300, 6)).astype(np.float32), np.full(300, -1), np.packbits(passed, axis=1), group, 5).run()
    assert sum(compared) == (np.bincount(where, minlength=40) * passed.sum(axis=1)).sum()


def test_blocks_hold_all_cells():
    sizes = np.array([3, 0, 5, 100, 1, 0, 9, 10, 11, 2])
    blocks = m.Blocks.of(sizes, 10)
    cells = blocks.cells_by_block()
    for cell, size in enumerate(sizes):
        own = [b for b, c in cells.items() if cell in c]
        assert len(own) == (-(-size // 10) if size else 0)
    assert all(len(c) == 1 or sizes[c].sum() <= 10 for c in cells.values())


def test_whole_walk_is_exact(spark):
    """With cells cut into parts, copies, scaled copies and ties."""
    rng = np.random.default_rng(5)
    vectors = {int(i): rng.integers(-3, 4, 7).tolist() for i in range(0, 900, 3)}
    vectors |= {1000 + i: [1.0, 2, 0, 0, -1, 0, 3] for i in range(60)}
    vectors |= {2000 + i: [2.0 ** (i + 1) * x for x in (1.0, 2, 0, 0, -1, 0, 3)] for i in range(9)}
    vectors = {i: [float(x) for x in v] for i, v in vectors.items() if any(v)}
    close(found(m.nearest_neighbours(table(spark, vectors.items()), recall=1.0, block_entries=20, least_entries=10**6)), brute_force(vectors))


def test_recall(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir.rsplit('/', 1)[0]}/sf0.1/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in frame.select("vec_id", "embedding").collect()}
    expected = brute_force(vectors)
    got = found(m.nearest_neighbours(frame, least_entries=6))
    hits = sum(len({j for _, j in got[i]} & {j for _, j in expected[i]}) for i in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    scores = {(i, j): s for i, own in brute_force(vectors, neighbours=10**6).items() for s, j in own}
    assert all(abs(scores[i, j] - s) < 1e-12 for i, own in got.items() for s, j in own)


def test_clustered_vectors_need_a_small_share():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(200, 16))
    points = np.repeat(centres, 40, axis=0) + rng.normal(scale=0.05, size=(8000, 16))
    index = m.fit(points, 22, 5)
    assert index.share < 0.05


EDGES = [
    (None, [1.0, 0.0]),
    (50, None),
    (100, []),
    (150, [0.0, 0.0]),
    (200, [float("nan"), 1.0]),
    (250, [float("inf"), 1.0]),
    (300, [None, 1.0]),
    (350, [1.0, 2.0, 3.0]),
    (400, [1e300, 1e300]),
    (401, [1e-300, 1.1e-300]),
    (402, [-1.0, -1.0]),
    (403, [-0.0, 1.0]),
    (404, [0.0, 1.0]),
    (400, [1e300, 1e300]),
]


def test_edges(spark):
    got = found(m.nearest_neighbours(table(spark, EDGES)))
    assert got.keys() == {400}
    assert [j for _, j in got[400]] == [401, 403, 404, 402]
    assert got[400][1][0] == got[400][2][0] and abs(got[400][3][0] + 1) < 1e-12


@pytest.mark.parametrize("rows", [[], [(50, None)], [(50, [1.0, 2.0])]])
def test_nothing_to_find(spark, rows):
    out = m.nearest_neighbours(table(spark, rows))
    assert out.columns == ["query_id", "rank", "vec_id", "score"] and out.count() == 0


def test_a_key_with_several_vectors(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [1.0, 0.1]), (1, [0.1, 1.0]), (2, [1.0, 1.0])]
    out = sorted((r["rank"], r.vec_id) for r in m.nearest_neighbours(table(spark, rows)).collect())
    assert out == [(1, 1), (1, 1), (2, 2), (2, 2)]
