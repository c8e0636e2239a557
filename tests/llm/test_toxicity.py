import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from asterloom.llm import toxicity as t
from tests.llm.cases import CLASHING, EDGES, documents

CATEGORIES = {"low_quality": ("quality", 0), "toxic": ("toxic", 1)}
LABEL = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())])


def made(n, seed=1):
    """Texts with rude words, where the second category needs the first one's word, too."""
    rng = np.random.default_rng(seed)
    texts, labels = [], []
    for _ in range(n):
        words = [f"w{j}" for j in rng.integers(0, 300, 40)]
        rude, aimed = rng.random() < 0.4, rng.random() < 0.5
        words[3:3] = ["Blasted" + "abcdefgh"[rng.integers(8)]] * rude + ["you"] * aimed
        texts.append(" ".join(words))
        labels.append((rude, rude and aimed))
    return texts, np.array(labels).astype(int)


def test_chain_on_unseen_texts():
    texts, labels = made(1500)
    chain = t.train(pa.array(texts), labels, ["rude", "aimed"])
    unseen, truth = made(400, seed=2)
    found = chain.probabilities(pa.array(unseen)) >= chain.thresholds
    assert (found == truth).mean(axis=0).min() > 0.97
    assert len(chain.models[0].dense) == 0 and len(chain.models[1].dense) == 1 and chain.models[1].dense[0] > 0


def test_flags_what_is_labelled(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    train, test = labels.filter("doc_id % 4 <> 1"), labels.filter("doc_id % 4 = 1")
    rows = t.classify(docs.join(test, "doc_id"), t.learn(docs, train, CATEGORIES), ["is_low", "is_toxic"]).collect()
    english = {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").filter("lang = 'en'").collect()}
    rows = [r for r in rows if r.doc_id in english]
    assert len(rows) > 30
    assert np.mean([r.is_toxic == bool(r.toxic) for r in rows]) > 0.9


def test_edges(spark):
    texts, labels = made(300)
    chain = t.train(pa.array(texts), labels, ["a", "b"])
    rows = EDGES + [(50, texts[0]), (51, "!!! ...")]
    out = t.classify(documents(spark, rows, [*CLASHING[:2], "a"]), chain, ["a", "b"])
    assert out.columns[-4:] == ["a_score", "b_score", "a", "b"] and out.count() == len(rows)
    found = {r[0]: tuple(r[-4:]) for r in out.toDF(*[f"c{i}" for i in range(len(out.columns))]).collect()}
    assert all(found[i] == (0, 0, False, False) for i in (7, 8, 9, 51))


def test_nothing_to_learn_and_empty_tables(spark):
    none = spark.createDataFrame([], LABEL)
    nulls = spark.createDataFrame([(1, None, 1), (2, 0, None), (None, 1, 1)], LABEL)
    docs = documents(spark, [(1, "abc"), (2, "def")])
    assert t.learn(docs, none, CATEGORIES) is None and t.learn(docs, nulls, CATEGORIES) is None
    assert [r.toxic for r in t.classify(docs, None, list(CATEGORIES)).collect()] == [False, False]
    assert t.classify(documents(spark, []), None, ["toxic"]).collect() == []


def test_texts_that_share_some_words_are_no_copies():
    """All texts get the three words with the smallest hashes, which made them copies."""
    common = [f"{c}{j:03}" for c in "abcdefghijklmnopqrstuvxyz" for j in range(1000)]
    hashes = t.document_words(pa.array([" ".join(common)]))[0].reshape(len(common), -1)[:, 0]
    common = " ".join(common[j] for j in np.argsort(hashes)[:3])
    texts, labels = made(1500)
    chain = t.train(pa.array([f"{common} {x}" for x in texts]), labels, ["rude", "aimed"])
    unseen, truth = made(400, seed=2)
    found = chain.probabilities(pa.array(unseen)) >= chain.thresholds
    assert (found == truth).mean(axis=0).min() > 0.97


def test_copies_count_once_per_label():
    texts, labels = made(300)
    once = t.train(pa.array(texts), labels, ["a", "b"])
    twice = t.train(pa.array(texts + [" ".join(reversed(x.split())) for x in texts]), np.concatenate([labels, labels]), ["a", "b"])
    assert (once.vocabulary == twice.vocabulary).all() and all((a.weights == b.weights).all() for a, b in zip(once.models, twice.models))


def test_learning_in_spark_equals_learning_at_hand(spark):
    """Words counted in Spark give the chain that all texts together give; keys that come again count once."""
    texts, labels = made(600)
    rows = [(i, x) for i, x in enumerate(texts)] + [(5, texts[5])] * 40 + [(7, None)]
    docs = documents(spark, rows)
    known = spark.createDataFrame([(i, int(1 - a), int(b)) for i, (a, b) in enumerate(labels)] * 2, LABEL)
    chain = t.learn(docs, known, CATEGORIES)
    plain = t.train(pa.array(texts), labels, list(CATEGORIES))
    assert len(plain.vocabulary) > 0 and chain.vocabulary.tolist() == plain.vocabulary.tolist()
    for a, b in zip(chain.models, plain.models):
        assert np.allclose(a.weights, b.weights) and np.allclose(a.dense, b.dense) and np.isclose(a.base, b.base)
    assert np.allclose(chain.thresholds, plain.thresholds)


def test_chain_against_a_plain_one():
    """Each model's sum is taken word by word, the later one with the earlier one's probability."""
    texts, labels = made(400)
    chain = t.train(pa.array(texts), labels, ["a", "b"])
    place = {int(w): j for j, w in enumerate(chain.vocabulary)}
    for text, found in zip(texts[:60], chain.probabilities(pa.array(texts[:60]))):
        words = {text.lower() for text in text.split()}
        parts = words | {w[:n] for w in words for n in t.BEGINNINGS if len(w) > n}
        whole = {int(h) for w in words for h in t.document_words(pa.array([w]))[0]}
        known = sorted(place[h] for h in whole if h in place)
        assert len(whole) <= 2 * len(parts)
        earlier = []
        for model, p in zip(chain.models, found):
            x = model.base + sum(model.weights[j] for j in known) + sum(d * e for d, e in zip(model.dense, earlier))
            earlier.append(1 / (1 + np.exp(-x)))
            assert abs(earlier[-1] - p) < 1e-9


@pytest.mark.parametrize("value", [0, 1])
def test_one_sided_labels(value):
    texts, labels = made(60)
    chain = t.train(pa.array(texts), np.full_like(labels, value), ["a", "b"])
    found = chain.probabilities(pa.array(texts)) >= chain.thresholds
    assert (found == bool(value)).all()


def test_gradient_steps_reach_the_optimum():
    rng = np.random.default_rng(0)
    n, m = 300, 6
    x = rng.random((n, m)) < 0.3
    dense = rng.random((n, 1))
    truth = (rng.random(n) < t.sigmoid(x @ rng.normal(0, 2, m) + dense[:, 0] - 0.5)).astype(float)
    docs, words = np.nonzero(x)
    model = t.fit(truth, docs, words, m, dense)
    error = (model.probability(n, docs, words, dense) - truth) / n
    assert np.abs(x.T @ error + t.RIDGE * model.weights).max() < 2e-3 and abs(error.sum()) < 2e-3
