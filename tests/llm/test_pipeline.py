import re
import zlib

import pytest

import corpus_pipeline as c
from asterloom.llm.packing import encoder, vocabulary_path
from tests.llm.cases import CLASHING, EDGES, documents, prose
from tests.llm.test_decontaminate import ITEM, brute as brute_decontaminate
from tests.llm.test_simhash import brute as brute_simhash
from tests.llm.test_suffix_dedup import brute as brute_suffix

ROWS = [(i + 1000, t) for i, t in prose(3, 90, vocabulary=60, longest=200)] + EDGES


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A benchmark whose items are passages of some documents."""
    path = str(tmp_path_factory.mktemp("bench"))
    items = [(j, " ".join(ROWS[j * 9][1].split()[5:40])) for j in range(6)]
    spark.createDataFrame(items, ITEM).write.parquet(f"{path}/benchmark.parquet")
    documents(spark, ROWS).write.parquet(f"{path}/documents.parquet")
    return path, items


def texts(df):
    return sorted(((r[0], r[1]) for r in df.collect()), key=str)


def test_language_id_rejects_texts_without_letters(spark):
    docs = documents(spark, ROWS, CLASHING)
    out = c.language_id(spark, docs, "")
    assert out.columns == docs.columns
    expected = [(i, t) for i, t in ROWS if t and any(map(str.isalpha, t))]
    assert texts(out) == sorted(expected, key=str)


def test_language_id_rejects_other_languages(spark, monkeypatch):
    """Texts of another language than their label go, and texts of two; null labels contradict nothing."""
    import random

    rng = random.Random(2)
    words = {"en": "the of and to in that was his with for".split(), "de": "der die und nicht über für schön wenn auch ein".split()}
    text = lambda lang, n=60: " ".join(rng.choice(words[lang]) for _ in range(n))
    schema = documents(spark, []).schema
    rows = [(i, text(lang), lang, None, 0) for i, lang in enumerate(["en", "de"] * 60)]
    # Ids that are not learned from, as labels are wrong.
    unseen = [i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 4 == 2]
    kinds = [("de", "en"), ("en", "de"), ("de", None), (None, "en")]
    odd = [(i, text(of) if of else "12 34", lang, None, 0) for i, (of, lang) in zip(unseen, kinds)]
    docs = spark.createDataFrame(rows + odd, schema)
    assert sorted(r.doc_id for r in c.language_id(spark, docs, "").collect()) == [*range(120), unseen[2]]
    monkeypatch.setattr(c, "WANTED", frozenset(["de"]))
    assert sorted(r.doc_id for r in c.language_id(spark, docs, "").collect()) == [*range(1, 120, 2), unseen[2]]


def test_one_of_each_near_group_stays(spark):
    docs = documents(spark, ROWS, ["fingerprint", "root", "place"])
    out = c.simhash_near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    groups = brute_simhash(ROWS, 2)
    kept = [r[0] for r in out.collect()]
    assert len(kept) == len(set(kept))
    assert {i for i in kept if i is not None} == {g for _, _, g in groups if g is not None}
    assert (None in kept) == any(g is None for _, _, g in groups)


def test_repeated_rows_are_one_document(spark):
    rows = [(1, "a b c"), (1, "a b c"), (None, "q r s"), (None, "q r s"), (None, None), (2, None), (3, "A B C")]
    out = c.simhash_near_dedup(spark, documents(spark, rows), "")
    assert texts(out) == sorted([(1, "a b c"), (None, "q r s"), (2, None)], key=str)


def test_earlier_strings_are_cut(spark):
    docs = documents(spark, ROWS, ["kept", "n_removed"])
    out = c.suffix_array_dedup(spark, docs, "")
    assert out.columns == docs.columns
    rows = {(r[0], r[1]) for r in out.collect()}
    expected = set()
    for i, n, gone, _, kept in brute_suffix(ROWS, 50):
        text = kept.decode(errors="ignore")
        if text or not gone:
            expected.add((i, text))
    assert rows == expected
    assert all(r[4] == len(r[1]) for r in out.collect())


def test_contaminated_documents_go(spark, folder):
    docs = documents(spark, ROWS, ["contaminated", "spans"])
    out = c.benchmark_decontamination(spark, docs, folder[0])
    assert out.columns == docs.columns
    bad = {r[0] for r in brute_decontaminate(ROWS, folder[1], 13) if r[4]}
    assert bad and texts(out) == sorted(((i, t) for i, t in ROWS if i not in bad), key=str)


def test_whole_run(spark, folder):
    pieces = c.run(spark, folder[0]).collect()
    lengths = {}
    for r in pieces:
        lengths[r.doc_id] = lengths.get(r.doc_id, 0) + r.length
        assert len(r.tokens) == 4 * r.length
    assert lengths and all(lengths[r.doc_id] == r.doc_tokens for r in pieces)
    assert not {7, 8, 9} & set(lengths)
    encode = encoder(vocabulary_path("byte_bpe_50k.json"), vocabulary_path("byte_bpe_50k.tiktoken"))
    (first,) = [t for i, t in ROWS if i == min(x for x in lengths if x is not None)]
    assert lengths[min(x for x in lengths if x is not None)] <= len(encode(first)) + 1


def test_empty_table(spark, folder):
    for name, function in c.STAGES:
        out = function(spark, documents(spark, []), folder[0])
        assert out.collect() == [], name


def test_stages_are_those_of_the_contract():
    assert [n for n, _ in c.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "packing"]
    assert all(re.fullmatch("[a-z_]+", n) for n, _ in c.STAGES)
