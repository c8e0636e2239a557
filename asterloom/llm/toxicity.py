"""Toxicity categories by a chain of linear models over words and beginnings of words.

The models predict one category after the other. Each later model also sees the probabilities of
the earlier categories; while training these come from models that have not seen the document
(out-of-fold), so that the later models can trust them as they will be in use.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm import kernels as k
from asterloom.llm.chunks import arrow_schema, by_position, stage

#: Labelled documents that are learned from, about; a sample by hashed id bounds the training.
SAMPLE_DOCS = 10_000
#: Bytes of the beginnings of longer words that count as words of their own.
BEGINNINGS = (4, 5, 6)
#: Words that each model brings in, at most; documents that a word must stand in; and standard
#: deviations by which its count in the category must differ from chance.
WORDS, LEAST_DOCS, DEVIATIONS = 600, 5, 6.0
FOLDS = 3
RIDGE, ROUNDS = 1e-4, 200


def document_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts and of their beginnings, and where each text's begin."""
    data, offsets = k.flatten(texts)
    lower = k.LOWER[data]
    starts, ends, bounds = k.words(lower, offsets, k.ALPHANUMERIC)
    roll = k.Rolling(k.BYTE_VALUES[lower])
    n = ends - starts
    hashes = np.empty((len(starts), 1 + len(BEGINNINGS)), k.U)
    hashes[:, 0] = k.mix(roll(starts, ends) + n.astype(k.U))
    for j, size in enumerate(BEGINNINGS, 1):
        hashes[:, j] = np.where(n > size, k.mix(roll(starts, np.minimum(starts + size, ends)), size), hashes[:, 0])
    return hashes.ravel(), bounds * (1 + len(BEGINNINGS))


def word_presence(hashes: np.ndarray, bounds: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of document and known word, each once; words by their place in the vocabulary."""
    if len(vocabulary) == 0 or len(hashes) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    known = vocabulary[at] == hashes
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    pairs = k.distinct_sorted(np.sort(doc[known] * len(vocabulary) + at[known]))
    return pairs // len(vocabulary), pairs % len(vocabulary)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Linear:
    """Logistic regression over the presence of words and a few dense columns."""

    weights: np.ndarray
    dense: np.ndarray
    base: float

    def probability(self, n: int, docs: np.ndarray, words: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return sigmoid(np.bincount(docs, self.weights[words], minlength=n) + dense @ self.dense + self.base)


def fit(truth: np.ndarray, docs: np.ndarray, words: np.ndarray, n_words: int, dense: np.ndarray) -> Linear:
    """Ridge-regularised logistic regression by accelerated gradient steps.

    The step of each weight is the inverse of a bound on the curvature, so the steps cannot
    overshoot.
    """
    n = len(truth)
    size = np.bincount(docs, minlength=n) + np.abs(dense).sum(axis=1) + 1
    bend_w = np.bincount(words, size[docs] / (4 * n), minlength=n_words) + RIDGE
    bend_d = np.abs(dense).T @ size / (4 * n) + RIDGE
    bend_b = size.mean() / 4
    w, d, b = np.zeros(n_words), np.zeros(dense.shape[1]), 0.0
    wv, dv, bv = w, d, b
    for step in range(ROUNDS):
        error = (sigmoid(np.bincount(docs, wv[words], minlength=n) + dense @ dv + bv) - truth) / n
        ahead = step / (step + 3)
        w2 = wv - (np.bincount(words, error[docs], minlength=n_words) + RIDGE * wv) / bend_w
        d2 = dv - (dense.T @ error + RIDGE * dv) / bend_d
        b2 = bv - error.sum() / bend_b
        wv, dv, bv = w2 + ahead * (w2 - w), d2 + ahead * (d2 - d), b2 + ahead * (b2 - b)
        w, d, b = w2, d2, b2
    return Linear(w, d, b)


@dataclass
class Chain:
    """The words that count, and a model and a threshold for each category in turn."""

    categories: list[str]
    vocabulary: np.ndarray
    models: list[Linear] = field(default_factory=list)
    thresholds: list[float] = field(default_factory=list)

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        docs, words = word_presence(*document_words(texts), self.vocabulary)
        found = np.zeros((len(texts), 0))
        for model in self.models:
            found = np.column_stack([found, model.probability(len(texts), docs, words, found)])
        return found


def best_threshold(truth: np.ndarray, chance: np.ndarray) -> float:
    """The threshold with the best F1 on out-of-fold probabilities, half way to the next lower one."""
    if not truth.any():
        return 1.1
    order = np.argsort(-chance, kind="stable")
    hits = np.cumsum(truth[order])
    f1 = 2 * hits / (np.arange(1, len(truth) + 1) + truth.sum())
    ordered = chance[order]
    f1[:-1][ordered[:-1] == ordered[1:]] = 0
    best = int(f1.argmax())
    return float((ordered[best] + ordered[min(best + 1, len(ordered) - 1)]) / 2)


def most_telling(hits: np.ndarray, frequency: np.ndarray, share: float, limit: int) -> np.ndarray:
    """The words whose counts in a category differ most from what its share of documents gives."""
    expected = frequency * share
    far = np.abs(hits - expected) / np.sqrt(expected * (1 - share) + 1e-9)
    far[frequency < LEAST_DOCS] = 0
    best = np.argsort(-far, kind="stable")[:limit]
    return best[far[best] >= DEVIATIONS]


def _distinct_words(texts: pa.Array, step: int = 200):
    """Slices of the texts: the first one's number, distinct word hashes in order, and where each text's begin."""
    for at in range(0, len(texts), step):
        hashes, bounds = document_words(texts.slice(at, step))
        n = len(bounds) - 1
        doc = np.repeat(np.arange(n), np.diff(bounds))
        order = np.lexsort((hashes, doc))
        doc, hashes = doc[order], hashes[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
        yield at, hashes[new], np.searchsorted(doc[new], np.arange(n + 1))


def _digests(hashes: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    return [blake2b(hashes[a:b].tobytes(), digest_size=16).digest() for a, b in zip(bounds[:-1], bounds[1:])]


def train(texts: pa.Array, labels: np.ndarray, categories: list[str]) -> Chain:
    """A chain for the columns of ``labels`` (0 or 1), in their order, from texts at hand.

    Of texts with the same set of words and the same labels only the first counts, or their common
    labels would be learned by heart. ``learn`` does the same with texts in Spark.
    """
    seen, keep, docs, words = set(), [], [np.zeros(0, np.int64)], [np.zeros(0, k.U)]
    for at, hashes, bounds in _distinct_words(texts):
        for i, digest in enumerate(_digests(hashes, bounds)):
            own = digest, labels[at + i].tobytes()
            if own not in seen:
                seen.add(own)
                words.append(hashes[bounds[i] : bounds[i + 1]])
                docs.append(np.full(len(words[-1]), len(keep)))
                keep.append(at + i)
    labels, docs, words = labels[keep], np.concatenate(docs), np.concatenate(words)
    everything = k.distinct_sorted(np.sort(words))
    at = np.searchsorted(everything, words)
    frequency = np.bincount(at, minlength=len(everything))
    chosen = [
        most_telling(np.bincount(at, labels[docs, j], minlength=len(everything)), frequency, labels[:, j].mean(), WORDS)
        for j in range(labels.shape[1])
    ]
    chosen = np.unique(np.concatenate(chosen))
    known = np.isin(at, chosen)
    return _chain(everything[chosen], labels, docs[known], np.searchsorted(chosen, at[known]), categories)


def _chain(vocabulary: np.ndarray, labels: np.ndarray, docs: np.ndarray, words: np.ndarray, categories: list[str]) -> Chain:
    """The models of the chain, from pairs of document and place in the vocabulary. Folds are dealt by position."""
    chain = Chain(categories, vocabulary)
    n, n_words = len(labels), len(vocabulary)
    fold = np.arange(n) % FOLDS
    earlier = np.zeros((n, 0))
    for j in range(len(categories)):
        truth = labels[:, j].astype(float)
        unseen = np.zeros(n)
        for f in range(FOLDS):
            own = np.flatnonzero(fold != f)
            place = np.full(n, -1)
            place[own] = np.arange(len(own))
            inside = place[docs] >= 0
            model = fit(truth[own], place[docs[inside]], words[inside], n_words, earlier[own])
            whole = model.probability(n, docs, words, earlier)
            unseen[fold == f] = whole[fold == f]
        chain.models.append(fit(truth, docs, words, n_words, earlier))
        chain.thresholds.append(best_threshold(truth > 0, unseen))
        earlier = np.column_stack([earlier, unseen])
    return chain


def _word_sets(texts: DataFrame) -> DataFrame:
    """The rows with the distinct word hashes of ``text``, and a digest of these, in its place."""
    others = [f for f in texts.schema.fields if f.name != "text"]
    schema = T.StructType([*others, T.StructField("digest", T.BinaryType()), T.StructField("words", T.ArrayType(T.LongType()))])
    out = arrow_schema(schema.fields)

    def run(batches):
        for batch in batches:
            rest = batch.select([f.name for f in others])
            for at, hashes, bounds in _distinct_words(batch.column("text")):
                sets = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(hashes.view(np.int64)))
                columns = [*rest.slice(at, len(sets)).columns, pa.array(_digests(hashes, bounds), pa.binary()), sets]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return texts.mapInArrow(run, schema)


def _vocabulary(sample: DataFrame, truth: list[str]) -> np.ndarray:
    """The words that ``most_telling`` takes for each category, counted in Spark; at most ``WORDS`` of each come back."""
    shares = sample.agg(*[F.avg(t).alias(t) for t in truth]).first()
    counts = sample.select(F.explode("words").alias("word"), *truth).groupBy("word")
    counts = counts.agg(F.count(F.lit(1)).alias("n"), *[F.sum(t).alias(t) for t in truth]).filter(F.col("n") >= LEAST_DOCS)
    counts = stage(counts, "word_counts", small=True)
    chosen = []
    for t in truth:
        expected = F.col("n") * F.lit(shares[t])
        far = F.abs(F.col(t) - expected) / F.sqrt(expected * F.lit(1 - shares[t]) + F.lit(1e-9))
        unsigned = F.col("word").bitwiseXOR(F.lit(-(2**63)))
        best = counts.filter(far >= DEVIATIONS).orderBy(far.desc(), unsigned).limit(WORDS)
        chosen.append(best.select("word").toArrow().column(0).to_numpy().astype(np.int64))
    return np.unique(np.concatenate(chosen).view(k.U))


def _known_words(sample: DataFrame, truth: list[str], vocabulary: np.ndarray) -> DataFrame:
    """``(key, truth..., places)``: where in the vocabulary the words of each document are."""
    kept = ["key", *truth]
    schema = T.StructType([*[sample.schema[c] for c in kept], T.StructField("places", T.ArrayType(T.IntegerType()))])
    out = arrow_schema(schema.fields)

    def run(batches):
        for batch in batches:
            sets = batch.column("words")
            bounds = np.concatenate([[0], np.cumsum(pa.compute.list_value_length(sets).to_numpy(zero_copy_only=False))]).astype(np.int64)
            docs, places = word_presence(sets.flatten().to_numpy(zero_copy_only=False).view(k.U), bounds, vocabulary)
            ends = np.searchsorted(docs, np.arange(len(batch) + 1))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32()))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*[batch.column(c) for c in kept], lists], out)], schema=out)

    return sample.mapInArrow(run, schema)


def learn(docs: DataFrame, labels: DataFrame, categories: dict[str, tuple[str, int]], key: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS) -> Chain | None:
    """A chain from a bounded sample of the labelled documents.

    ``categories`` gives for each category, in the order of the chain, the label column and the
    value that means yes. About ``sample_docs`` keys are drawn by their hash; rows with a null
    label or text are not used. Of rows with the same key one is learned from: the smallest labels, and the text with
    the smallest digest of its words. Without any: None.

    Texts stay in the executors. Words are counted in Spark; to the driver come ``WORDS`` words a category, and for each
    drawn key its labels and the places of its words among these, however long the texts are.
    """
    truth = [f"l{j}" for j in range(len(categories))]
    usable = labels.select(F.col(f"`{key}`").alias("key"), *[F.col(f"`{c}`").alias(f"l{j}") for j, (c, _) in enumerate(categories.values())]).dropna()
    keys = usable.groupBy("key").agg(F.min(F.struct(*truth)).alias("row"))
    share = min(1.0, sample_docs / max(1, keys.count()))
    drawn = keys.filter(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < share * 1_000_000)
    drawn = drawn.select("key", *[(F.col(f"row.l{j}") == yes).cast("int").alias(f"l{j}") for j, (_, yes) in enumerate(categories.values())])
    texts = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).dropna()
    # About ``sample_docs`` rows of a key and labels.
    sets = _word_sets(texts.join(F.broadcast(drawn), "key"))
    one = sets.groupBy("key").agg(F.min(F.struct("digest", *truth, "words")).alias("row")).select("key", "row.*")
    one = one.groupBy("digest", *truth).agg(F.min(F.struct("key", "words")).alias("row")).select("row.*", *truth)
    sample = stage(one, "labelled", small=True)
    if not sample.take(1):
        return None
    vocabulary = _vocabulary(sample, truth)
    rows = _known_words(sample, truth, vocabulary).toArrow().sort_by("key")
    places = rows.column("places").combine_chunks()
    at = np.repeat(np.arange(len(rows)), pa.compute.list_value_length(places).to_numpy(zero_copy_only=False))
    known = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return _chain(vocabulary, np.column_stack([rows.column(t).to_numpy() for t in truth]).astype(np.int64), at, known, list(categories))


def classify(docs: DataFrame, chain: Chain | None, categories: list[str], text: str = "text") -> DataFrame:
    """The documents with ``<category>_score`` and ``<category>`` (boolean) in place of the text.

    Whole texts are looked at. A category is true if its score reaches the threshold that did best
    on unseen folds. Null texts and texts without words are false with score 0, as is everything
    if there was nothing to learn from. Repeated rows stay; an empty table gives an empty table.
    """
    frame, names = by_position(docs)
    here = names.index(text)
    keep = [j for j in range(len(names)) if j != here]
    added = [T.StructField(f"{c}_score", T.DoubleType()) for c in categories] + [T.StructField(c, T.BooleanType()) for c in categories]
    fields = [*[frame.schema.fields[j] for j in keep], *added]
    schema = T.StructType([T.StructField(f"x{j}", f.dataType) for j, f in enumerate(fields)])
    out = arrow_schema(schema.fields)

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                texts = batch.column(here)
                scores = np.zeros((len(batch), len(categories)))
                if chain is not None:
                    scores = chain.probabilities(texts)
                    scores[np.diff(document_words(texts)[1]) == 0] = 0
                true = scores >= (chain.thresholds if chain is not None else 2.0)
                columns = [pa.array(scores[:, j]) for j in range(len(categories))] + [pa.array(true[:, j]) for j in range(len(categories))]
                yield pa.RecordBatch.from_arrays([*[batch.column(j) for j in keep], *columns], schema=out)

    return frame.mapInArrow(run, schema).toDF(*[names[j] for j in keep], *[f.name for f in added])
