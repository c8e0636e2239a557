import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asterloom.llm import language as lang
from tests.llm.cases import CLASHING, EDGES, documents


@pytest.fixture(scope="module")
def network(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return lang.learn(docs, sample_docs=600)


def test_held_out_accuracy(spark, network):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lang.identify(docs.filter(lang.held_out("doc_id")), network).collect()
    assert len(out) > 200
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in out)
    assert np.mean([r.lang_pred == r.lang for r in out]) > 0.97


def test_held_out_documents_are_not_learned_from(spark):
    rows = [(i, "abc def " * 40) for i in range(200)]
    docs = documents(spark, rows).withColumn("lang", F.when(lang.held_out("doc_id"), "xx").when(F.col("doc_id") % 5 == 0, None).otherwise("en"))
    assert lang.learn(docs, sample_docs=50).languages == ["en"]


def test_edges(spark, network):
    rows = EDGES + [(20, "1234 !? 55"), (21, "漢")]
    out = lang.identify(documents(spark, rows, [*CLASHING[:2], "score"]), network)
    assert out.columns == ["doc_id", "lang", "source", "n_chars", *CLASHING[:2], "score", "lang_pred", "score"]
    found = out.toDF(*[f"c{i}" for i in range(len(out.columns))]).collect()
    by_id = {r[0]: (r[-2], r[-1]) for r in found}
    assert len(found) == len(rows)
    assert [by_id[i] for i in (7, 8, 9, 20)] == [("und", 0.0)] * 4
    assert by_id[10][0] in network.languages and by_id[21][0] in network.languages


def test_nothing_to_learn_and_empty_table(spark):
    assert lang.learn(documents(spark, [])) is None
    assert lang.identify(documents(spark, []), None).collect() == []
    assert [r.lang_pred for r in lang.identify(documents(spark, [(1, "abc")]), None).collect()] == ["und"]


def test_pairs_give_the_filters_responses(network):
    rng = np.random.default_rng(1)
    windows = rng.integers(0, lang.CLASSES, (lang.WINDOW, 9))
    pooled = []
    for f, b in zip(network.filters, network.bias):
        at = range(lang.WINDOW - len(f) + 1)
        response = np.stack([sum(f[i][windows[a + i]] for i in range(len(f))) for a in at])
        pooled.append(np.maximum(response.max(axis=0) + b, 0))
    expected = np.concatenate(pooled, axis=1) @ network.weights + network.base
    expected -= np.log(np.exp(expected).sum(axis=1, keepdims=True))
    assert np.allclose(network.log_probabilities(windows), expected, atol=1e-4)


def test_every_window_counts(network):
    german = "der die und nicht einung schver keit für über " * 5
    french = "le la les des pas pour eau élle est une dans " * 60
    languages, _ = lang.predict(network, pa.array([german + french, german]))
    assert languages == ["fr", "de"]
