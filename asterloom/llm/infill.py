"""Fill-in-the-middle examples of documents, by rotating blocks of a byte buffer in place.

A text is put into one buffer with a sentinel in front of each of its three parts. The order of an
example differs from that of the text by one exchange of neighbouring blocks, which three
reversals do within the buffer; the same exchange, with the lengths swapped, restores the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm.chunks import arrow_schema, by_position

PLAIN, PSM, SPM = "plain", "psm", "spm"


@dataclass(frozen=True)
class Sentinels:
    """What stands in front of prefix, suffix and middle.

    The first byte of each stands nowhere else in them, so no sentinel can be read across the
    border of a text and a sentinel.
    """

    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"

    def __post_init__(self):
        all_ = (self.prefix, self.suffix, self.middle)
        if len(set(all_)) < 3 or not all(all_) or any(s[:1] in t[1:] for s in all_ for t in all_):
            raise ValueError("sentinels must differ, and begin with bytes that stand nowhere else in them")

    def within(self, text: bytes) -> bool:
        return self.prefix in text or self.suffix in text or self.middle in text


@dataclass(frozen=True)
class Rates:
    """Of 100 texts, how many are transformed, and how many of these have the suffix first."""

    fim: int = 100
    spm: int = 50


def reverse(buffer: np.ndarray, start: int, end: int) -> None:
    """Reverse a slice of the buffer, half by half."""
    half = (end - start) // 2
    front = buffer[start : start + half].copy()
    buffer[start : start + half] = buffer[end - half : end][::-1]
    buffer[end - half : end] = front[::-1]


def rotate(buffer: np.ndarray, start: int, border: int, end: int) -> None:
    """Exchange the neighbouring blocks before and after the border: each is reversed, then both."""
    reverse(buffer, start, border)
    reverse(buffer, border, end)
    reverse(buffer, start, end)


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends, its line feed included; a rest without one is a line, too."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.append(ends, len(text)) if len(text) and (len(ends) == 0 or ends[-1] < len(text)) else ends


def n_chars(text: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def draws(key, seed: int) -> list[int]:
    """Four numbers below 2**32 that follow from seed and key (null: empty)."""
    digest = sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[4 * i : 4 * i + 4], "big") for i in range(4)]


def transform(text: bytes, numbers: list[int], rates: Rates = Rates(), marks: Sentinels = Sentinels()):
    """Lines, form, ends of prefix and middle in bytes, and the example."""
    ends = line_ends(text)
    n = len(ends)
    if not text or marks.within(text) or numbers[2] % 100 >= rates.fim:
        return n, PLAIN, None, None, text
    first, last = sorted((numbers[0] % (n + 1), numbers[1] % (n + 1)))
    a, b = (int(ends[i - 1]) if i else 0 for i in (first, last))
    buffer = bytearray(text)
    buffer[b:b] = marks.suffix
    buffer[a:a] = marks.middle
    buffer[0:0] = marks.prefix
    # Now prefix, middle, suffix, each behind its sentinel.
    middle = len(marks.prefix) + a
    suffix = middle + len(marks.middle) + b - a
    view = np.frombuffer(buffer, np.uint8)
    if numbers[3] % 100 < rates.spm:
        rotate(view, 0, suffix, len(view))
        return n, SPM, a, b, bytes(buffer)
    rotate(view, middle, suffix, len(view))
    return n, PSM, a, b, bytes(buffer)


def restore(example: bytes, form: str, marks: Sentinels = Sentinels()) -> bytes:
    """The text of an example, from the example and its form alone."""
    if form == PLAIN:
        return example
    buffer = bytearray(example)
    view = np.frombuffer(buffer, np.uint8)
    at = {m: example.index(m) for m in (marks.prefix, marks.suffix, marks.middle)}
    if form == SPM:
        border, start = at[marks.prefix], 0
    else:
        border, start = at[marks.middle], at[marks.suffix]
    rotate(view, start, border, len(view))
    del view  # a buffer that is looked at cannot shrink
    size = len(buffer)
    if form == SPM:
        prefix, middle, suffix = 0, at[marks.middle] - border, size - border
    else:
        prefix, middle, suffix = 0, start, start + size - border
    for where, mark in ((suffix, marks.suffix), (middle, marks.middle), (prefix, marks.prefix)):
        if buffer[where : where + len(mark)] != mark:
            raise ValueError("not an example of this form and these sentinels")
        del buffer[where : where + len(mark)]
    return bytes(buffer)


ADDED = [
    T.StructField("n", T.LongType()),
    T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.BinaryType()),
]


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7, rates: Rates = Rates(), marks: Sentinels = Sentinels()
) -> DataFrame:
    """The documents with a fill-in-the-middle example in place of the text.

    Added columns: ``n`` (lines), ``form`` (``plain``, ``psm``: prefix, suffix, middle, or
    ``spm``: suffix, prefix, middle), ``prefix_chars`` and ``middle_chars`` (code points; null if
    plain) and ``output``. Cuts lie between lines and follow, like the form, from the SHA-256 of
    seed and key, so a document always gives the same example, whatever partition it is in. Null
    and empty texts are plain and empty, texts that hold a sentinel are plain; a null key counts
    as empty text; repeated rows give equal examples; an empty table gives an empty table. Other columns stay.
    Each text is one row's work: a task holds a batch of texts and one buffer.
    """
    frame, names = by_position(docs)
    k_, here = names.index(key), names.index(text)
    keep = [j for j in range(len(names)) if j != here]
    columns = [F.col(f"c{j}").cast("binary").alias(f"c{j}") if j == here else F.col(f"c{j}") for j in range(len(names))]
    # The key as text comes last: its own column stays as it is.
    frame = frame.select(*columns, F.col(f"c{k_}").cast("string").alias("seeded"))
    fields = [*[frame.schema.fields[j] for j in keep], *ADDED]
    schema = T.StructType([T.StructField(f"x{j}", f.dataType) for j, f in enumerate(fields)])
    out = arrow_schema(schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 200):
                batch = whole.slice(at, 200)
                columns: list[list] = [[], [], [], [], []]
                for own, value in zip(batch.column("seeded").to_pylist(), batch.column(here).to_pylist()):
                    raw = value or b""
                    n, form, a, b, example = transform(raw, draws(own, seed), rates, marks)
                    chars = (None, None) if a is None else (n_chars(raw[:a]), n_chars(raw[a:b]))
                    for column, x in zip(columns, (n, form, *chars, example)):
                        column.append(x)
                added = [pa.array(x, f.type) for x, f in zip(columns, list(out)[len(keep) :])]
                yield pa.RecordBatch.from_arrays([*[batch.column(j) for j in keep], *added], schema=out)

    done = frame.mapInArrow(run, schema)
    last = F.col(f"x{len(fields) - 1}").cast("string").alias(f"x{len(fields) - 1}")
    done = done.select(*done.columns[:-1], last)
    return done.toDF(*[names[j] for j in keep], *[f.name for f in ADDED])


def restore_texts(examples: DataFrame, output: str = "output", form: str = "form", restored: str = "restored", marks: Sentinels = Sentinels()) -> DataFrame:
    """The examples with the exact text that each was made from, from ``output`` and ``form`` alone.

    Null outputs give an empty text, a null form counts as plain. Other columns stay.
    """
    frame, names = by_position(examples)
    o_, f_ = names.index(output), names.index(form)
    frame = frame.select("*", F.col(f"c{o_}").cast("binary").alias("raw"))
    fields = [*frame.schema.fields[:-1], T.StructField("restored", T.BinaryType())]
    schema = T.StructType([T.StructField(f"x{j}", f.dataType) for j, f in enumerate(fields)])
    out = arrow_schema(schema.fields)

    def run(batches):
        for whole in batches:
            for at in range(0, len(whole), 200):
                batch = whole.slice(at, 200)
                both = zip(batch.column("raw").to_pylist(), batch.column(f_).to_pylist())
                texts = pa.array([restore(x or b"", y or PLAIN, marks) for x, y in both], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], texts], schema=out)

    done = frame.mapInArrow(run, schema)
    done = done.select(*done.columns[:-1], F.col(done.columns[-1]).cast("string").alias(done.columns[-1]))
    return done.toDF(*names, restored)
