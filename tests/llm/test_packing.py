import numpy as np
import pytest

from asterloom.llm import packing as p
from tests.llm.cases import CLASHING, EDGES, documents, prose

JSON = p.vocabulary_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(JSON)


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


ROWS = prose(1) + EDGES + [(500, "a <|endoftext|> b"), (501, " " * 5000 + "x"), (502, "Ω≈ç√ I'll 12345  \n\n\t z")]


@pytest.mark.parametrize("length", [7, 64, 1024])
def test_round_trip(spark, tokenizer, length):
    pieces = p.pack(documents(spark, ROWS, ["part", "tokens", "begin"]), length=length)
    names = pieces.columns
    assert names == ["doc_id", "lang", "source", "n_chars", "part", "tokens", "begin", "start", "length", "doc_tokens", "sequence_id", "offset", "tokens"]
    rows = pieces.toDF(*names[:5], "t", *names[6:]).collect()
    expected = sorted((ids(tokenizer, t) for _, t in ROWS))
    stream = {}
    for r in rows:
        assert len(r.tokens) == 4 * r.length > 0 and 0 <= r.offset and r.offset + r.length <= length
        for j in range(r.length):
            assert stream.setdefault(r.sequence_id * length + r.offset + j, None) is None
            stream[r.sequence_id * length + r.offset + j] = (int(np.frombuffer(r.tokens, "<u4")[j]), r.start + j, r.doc_tokens)
    n = sum(map(len, expected))
    assert sorted(stream) == list(range(n))
    docs, own = [], []
    for at in range(n):
        token, place, total = stream[at]
        assert place == len(own)
        own.append(token)
        if len(own) == total:
            docs.append(own)
            own = []
    assert sorted(docs) == expected and not own


def test_sequences_are_full_but_the_last(spark, tokenizer):
    pieces = p.pack(documents(spark, ROWS), length=32)
    rows = sorted(p.sequences(pieces, 32).collect())
    n = sum(len(ids(tokenizer, t)) for _, t in ROWS)
    assert [r.sequence_id for r in rows] == list(range(-(-n // 32)))
    assert all(len(r.tokens) == 128 and r.boundaries[0] == 0 for r in rows)
    assert sum(r.n_tokens for r in rows) == n and all(r.n_tokens == 32 for r in rows[:-1])


def test_joined_offsets_agree(spark, monkeypatch):
    docs = documents(spark, ROWS).coalesce(1)
    one = sorted(p.pack(docs, length=50).collect(), key=str)
    monkeypatch.setattr(p, "BROADCAST_PARTS", 0)
    assert sorted(p.pack(docs, length=50).collect(), key=str) == one


def test_empty_table(spark):
    assert p.pack(documents(spark, [])).collect() == []


def test_groups_of_partitions(spark):
    tokens = spark.createDataFrame([(i, i + 1) for i in range(0, 40, 3)] + [(3, 5)], "part long, n_tokens long")
    found = {r.part: r.offset for r in p.part_offsets(tokens, group=7).collect()}
    total = 0
    for i in range(0, 40, 3):
        assert found[i] == total
        total += i + 1 + (5 if i == 3 else 0)


def test_fast_ids_are_the_tokenizers(tokenizer):
    encode = p.encoder(JSON, p.vocabulary_path("byte_bpe_50k.tiktoken"))
    for _, text in ROWS:
        assert list(encode(text or "")) == ids(tokenizer, text)[:-1]
