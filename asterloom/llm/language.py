"""Language identification by a convolutional network over bytes, trained in numpy.

Filters of several widths slide over the byte classes of fixed-length windows; the greatest
response of each filter in a window goes to a softmax layer. A document's prediction is the mean
over all windows of its whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm import kernels as k
from asterloom.llm.chunks import arrow_schema, by_position

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 24
#: Training documents and windows of each, at most: a sample by hashed id bounds the training.
SAMPLE_DOCS, SAMPLE_WINDOWS = 6000, 3
STEPS, BATCH, RATE = 1500, 128, 0.01
#: Windows that are held as arrays at a time.
AT_ONCE = 512

#: Byte classes: a-z in either case, blank, digit, other ASCII, each byte of other characters.
BLANK, DIGIT, OTHER, CLASSES = 26, 27, 28, 128
BYTE_CLASS = np.full(256, OTHER, np.int64)
BYTE_CLASS[0x41:0x5B] = BYTE_CLASS[0x61:0x7B] = np.arange(26)
BYTE_CLASS[~k.NOT_SPACE] = BLANK
BYTE_CLASS[0x30:0x3A] = DIGIT
BYTE_CLASS[0x80:0xC0] = 29 + np.arange(64)
BYTE_CLASS[0xC0:] = 93 + np.arange(64) // 2


@dataclass
class Network:
    """Filters ``[width][place, class, filter]``, their biases, and the softmax layer."""

    languages: list[str]
    filters: list[np.ndarray]
    bias: list[np.ndarray]
    weights: np.ndarray
    base: np.ndarray

    def pairs(self) -> list[list[np.ndarray]]:
        """Responses to pairs of neighbouring classes, so that a filter takes half the look-ups."""
        if not hasattr(self, "_pairs"):
            self._pairs = []
            for f in self.filters:
                tables = [(f[i][:, None] + f[i + 1][None]).reshape(-1, f.shape[2]) for i in range(0, len(f) - 1, 2)]
                self._pairs.append(tables + ([f[-1]] if len(f) % 2 else []))
        return self._pairs

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Per window (a column of classes) the logarithm of each language's probability."""
        length, n = windows.shape
        pair = windows[:-1] * CLASSES + windows[1:]
        pooled = []
        for f, bias, tables in zip(self.filters, self.bias, self.pairs()):
            count = length - len(f) + 1
            best = np.full((n, f.shape[2]), -np.inf, np.float32)
            for at in range(0, count, 32):
                to = min(at + 32, count)
                response = None
                for i, table in enumerate(tables):
                    values = (pair if table.shape[0] > CLASSES else windows)[at + 2 * i : to + 2 * i]
                    part = table[values]
                    response = part if response is None else np.add(response, part, out=response)
                np.maximum(best, response.max(axis=0), out=best)
            pooled.append(np.maximum(best + bias, 0))
        return _log_softmax(np.concatenate(pooled, axis=1) @ self.weights + self.base)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=1, keepdims=True))


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of all windows of the texts, and the text of each; at least one per text."""
    n = np.diff(offsets)
    counts = np.maximum(1, -(-n // WINDOW))
    doc = np.repeat(np.arange(len(n)), counts)
    start = k.ranges(np.zeros(len(n), np.int64), counts) * WINDOW + offsets[:-1][doc]
    return start, np.minimum(start + WINDOW, offsets[1:][doc]), doc


def window_classes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The byte classes of windows, one column each, filled up with blanks."""
    at = start[None, :] + np.arange(WINDOW)[:, None]
    if len(data) == 0:
        return np.full(at.shape, BLANK)
    return np.where(at < end[None, :], BYTE_CLASS[data[np.minimum(at, len(data) - 1)]], BLANK)


def train(windows: np.ndarray, labels: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """A network for the languages of the labels, by Adam over random batches of windows.

    Languages weigh alike, however many windows each has.
    """
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    truth = np.searchsorted(languages, labels)
    share = np.bincount(truth, minlength=len(languages))
    chance = (1 / share)[truth]
    chance /= chance.sum()
    size = len(WIDTHS) * FILTERS
    params = [rng.normal(0, 0.1, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS]
    params += [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    params += [rng.normal(0, 0.1, (size, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    n_widths = len(WIDTHS)
    for step in range(1, steps + 1):
        picked = rng.choice(len(labels), BATCH, p=chance)
        x, y = windows[:, picked], truth[picked]
        pooled, places = [], []
        for f, bias in zip(params[:n_widths], params[n_widths : 2 * n_widths]):
            count = len(x) - len(f) + 1
            response = f[0][x[:count]]
            for i in range(1, len(f)):
                response += f[i][x[i : i + count]]
            place = response.argmax(axis=0)
            places.append(place)
            pooled.append(np.take_along_axis(response, place[None], 0)[0] + bias)
        hidden = np.concatenate(pooled, axis=1)
        active = np.maximum(hidden, 0)
        error = np.exp(_log_softmax(active @ params[-2] + params[-1]))
        error[np.arange(BATCH), y] -= 1
        error /= BATCH
        back = (error @ params[-2].T) * (hidden > 0)
        slopes = []
        for j, (f, place) in enumerate(zip(params[:n_widths], places)):
            own = back[:, j * FILTERS : (j + 1) * FILTERS]
            slope = np.zeros_like(f)
            which = np.broadcast_to(np.arange(FILTERS), own.shape)
            for i in range(len(f)):
                seen = x[place + i, np.arange(BATCH)[:, None]]
                np.add.at(slope[i], (seen, which), own)
            slopes.append(slope)
        slopes += [back[:, j * FILTERS : (j + 1) * FILTERS].sum(axis=0) for j in range(n_widths)]
        slopes += [active.T @ error, error.sum(axis=0)]
        rate = RATE * (1 - step / (steps + 1))
        for p, g, m, v in zip(params, slopes, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(languages, params[:n_widths], params[n_widths : 2 * n_widths], params[-2], params[-1])


def held_out(key: str) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """A network from a bounded sample of the documents that are not held out.

    The sample has about ``sample_docs`` documents, chosen by hashed id and alike for each
    language, and ``SAMPLE_WINDOWS`` windows of each. Without any labelled text: None.
    """
    usable = docs.filter(~held_out(key) & F.col(f"`{key}`").isNotNull() & F.col(f"`{lang}`").isNotNull() & (F.octet_length(F.col(f"`{text}`")) > 0))
    usable = usable.select(F.col(f"`{key}`").alias("key"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    sizes = {r.lang: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not sizes:
        return None
    each = sample_docs / len(sizes)
    draw = F.pmod(F.xxhash64("key"), F.lit(1_000_000)) / 1_000_000
    share = F.element_at(F.map_from_arrays(F.array(*map(F.lit, sizes)), F.array(*[F.lit(min(1.0, each / n)) for n in sizes.values()])), F.col("lang"))

    def windows(batches):
        for batch in batches:
            data, offsets = k.flatten(batch.column("text"))
            start, end, doc = cut_windows(data, offsets)
            counts = np.bincount(doc, minlength=len(batch))
            place = np.arange(len(doc)) - (np.cumsum(counts) - counts)[doc]
            step = np.maximum(1, counts // SAMPLE_WINDOWS)[doc]
            keep = (place % step == 0) & (place // step < SAMPLE_WINDOWS)
            columns = [
                batch.column("key").take(pa.array(doc[keep])),
                pa.array(place[keep]),
                batch.column("lang").take(pa.array(doc[keep])),
                pa.array([data[a:b].tobytes() for a, b in zip(start[keep], end[keep])], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "place", "lang", "window"])

    kind = usable.schema["key"].dataType.simpleString()
    rows = usable.filter(draw < share).mapInArrow(windows, f"key {kind}, place long, lang string, window binary").toArrow()
    rows = rows.sort_by([("key", "ascending"), ("place", "ascending"), ("window", "ascending")])
    data, offsets = k.flatten(rows.column("window"))
    return train(window_classes(data, offsets[:-1], offsets[1:]), rows.column("lang").to_pylist())


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def predict(network: Network | None, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """The language of each text and its probability."""
    data, offsets = k.flatten(texts)
    start, end, doc = cut_windows(data, offsets)
    languages, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if network is None:
        return languages, score
    total = np.zeros((len(texts), len(network.languages)))
    weight = np.zeros(len(texts))
    for at in range(0, len(doc), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        size = np.maximum(end[part] - start[part], 1)
        found = network.log_probabilities(window_classes(data, start[part], end[part]))
        np.add.at(total, doc[part], found * size[:, None])
        np.add.at(weight, doc[part], size)
    chance = np.exp(_log_softmax(total / weight[:, None])) if len(texts) else total
    for i, value in enumerate(texts):
        if has_letter(value.as_py()):
            best = int(chance[i].argmax())
            languages[i], score[i] = network.languages[best], min(1.0, chance[i, best])
    return languages, score


def identify(docs: DataFrame, network: Network | None, text: str = "text", keep_text: bool = False) -> DataFrame:
    """The documents with ``lang_pred`` and ``score`` in place of the text, or beside it.

    Every byte of the text is looked at. Null texts and texts without any letter are ``und`` with
    score 0, as are all texts if there was nothing to learn from. Repeated rows stay; an empty
    table gives an empty table.
    """
    frame, names = by_position(docs)
    here = names.index(text)
    keep = [j for j in range(len(names)) if keep_text or j != here]
    fields = [*[frame.schema.fields[j] for j in keep], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    out = arrow_schema(fields)

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 200):
                batch = whole.slice(at, 200)
                languages, score = predict(network, batch.column(here))
                columns = [*[batch.column(j) for j in keep], pa.array(languages, pa.string()), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    return frame.mapInArrow(run, T.StructType(fields)).toDF(*[names[j] for j in keep], "lang_pred", "score")
