"""Packing: the tokens of all documents in a row, cut into sequences of one length.

A first pass writes each document's tokens with its place in its partition and sums the tokens
of each partition; prefix sums over these totals give the offset of each partition in the whole
row. A second pass cuts at the multiples of the sequence length.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asterloom.llm.chunks import arrow_schema, by_position, stage

SEQUENCE_TOKENS = 1024
SEPARATOR = 0
TOKENIZER = "byte_bpe_50k"
#: Partitions whose offsets are sent to all tasks; with more they are joined.
BROADCAST_PARTS = 1_000_000
_ENCODERS: dict[str, object] = {}


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Token ids of texts as the tokenizer file gives them, without special tokens.

    The same vocabulary as ranks is about five times as fast and gives the same ids. Texts that
    hold a special token's own string, and any that it refuses, go to the tokenizer file.
    """

    def __init__(self, tokenizer_json: str, ranks_file: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(tokenizer_json)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_file:
            import public_tokenizers
            import tiktoken

            with open(ranks_file, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=())
            except BaseException as error:  # the library's own panics are no Exceptions
                if isinstance(error, (KeyboardInterrupt, SystemExit)):
                    raise
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(tokenizer_json: str, ranks_file: str | None) -> Encoder:
    """One encoder per Python worker."""
    if tokenizer_json not in _ENCODERS:
        _ENCODERS[tokenizer_json] = Encoder(tokenizer_json, ranks_file)
    return _ENCODERS[tokenizer_json]


def tokenize(docs: DataFrame, text: str, tokenizer_json: str, ranks_file: str | None = None, separator: int = SEPARATOR) -> DataFrame:
    """The documents with ``part``, ``before``, ``n_tokens`` and ``tokens`` in place of the text.

    ``tokens`` are little-endian unsigned 32-bit ids with the separator at the end, ``before`` the
    tokens that come earlier in the partition ``part``.
    """
    fields = [f for f in docs.schema.fields if f.name != text]
    added = [("part", T.LongType()), ("before", T.LongType()), ("n_tokens", T.LongType()), ("tokens", T.BinaryType())]
    fields += [T.StructField(n, t) for n, t in added]
    out = arrow_schema(fields)
    keep = [i for i, n in enumerate(docs.columns) if n != text]
    here = docs.columns.index(text)

    def run(batches):
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        encode = encoder(tokenizer_json, ranks_file)
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                tokens = [np.append(encode(x or ""), separator).astype("<u4") for x in batch.column(here).to_pylist()]
                counts = np.array([len(x) for x in tokens], np.int64)
                columns = [
                    *[batch.column(i) for i in keep],
                    pa.array(np.full(len(batch), part, np.int64)),
                    pa.array(before + np.cumsum(counts) - counts),
                    pa.array(counts),
                    pa.array([x.tobytes() for x in tokens], pa.binary()),
                ]
                before += int(counts.sum())
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    return docs.mapInArrow(run, T.StructType(fields))


def part_offsets(tokens: DataFrame, group: int = 1000) -> DataFrame:
    """``(part, offset)``: prefix sums of the partitions' totals, within groups and over them."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("g", F.floor(F.col("part") / group))
    groups = totals.groupBy("g").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("g", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("part", "g", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("own"))
    return totals.join(groups, "g").select("part", (F.col("base") + F.col("own")).alias("offset"))


def pack(
    docs: DataFrame,
    text: str = "text",
    tokenizer_json: str | None = None,
    ranks_file: str | None = None,
    length: int = SEQUENCE_TOKENS,
    separator: int = SEPARATOR,
) -> DataFrame:
    """One row per piece of a document, in sequences of ``length`` tokens.

    The tokens of all documents, each followed by the separator, form one row of tokens in the
    order of the partitions they are read in; every ``length`` tokens make a sequence, and only
    the last one may be shorter. A piece is what a document has in one sequence. Added columns in
    place of the text: ``start`` (tokens of the document before the piece), ``length``,
    ``doc_tokens`` (with the separator), ``sequence_id``, ``offset`` (in the sequence) and
    ``tokens`` (little-endian unsigned 32-bit ids). Null and empty texts are the separator alone;
    repeated rows are packed as often as they stand there; an empty table gives no pieces.
    """
    if tokenizer_json is None:
        tokenizer_json, ranks_file = vocabulary_path(f"{TOKENIZER}.json"), vocabulary_path(f"{TOKENIZER}.tiktoken")
    frame, names = by_position(docs)
    here = f"c{names.index(text)}"
    tokens = stage(tokenize(frame, here, tokenizer_json, ranks_file, separator), "tokens")
    offsets = stage(part_offsets(tokens), "offsets")
    if offsets.count() <= BROADCAST_PARTS:
        offsets = F.broadcast(offsets)
    others = [n for n in frame.columns if n != here]
    placed = tokens.join(offsets, "part")
    placed = placed.select(*others, "tokens", "n_tokens", (F.col("offset") + F.col("before")).alias("begin"))
    added = [(n, T.LongType()) for n in ("start", "length", "doc_tokens", "sequence_id", "offset")]
    fields = [*[frame.schema[n] for n in others], *[T.StructField(n, t) for n, t in added], T.StructField("tokens", T.BinaryType())]
    out = arrow_schema(fields)

    def cut(batches):
        for batch in batches:
            begin = batch.column("begin").to_numpy(zero_copy_only=False)
            n = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            first, last = begin // length, (begin + n - 1) // length
            pieces = last - first + 1
            doc = np.repeat(np.arange(len(n)), pieces)
            sequence = np.repeat(first, pieces) + np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            low = np.maximum(sequence * length, begin[doc])
            high = np.minimum((sequence + 1) * length, (begin + n)[doc])
            start, size = low - begin[doc], high - low
            held = [x.as_buffer() for x in batch.column("tokens")]
            values = [held[d][4 * a : 4 * (a + m)] for d, a, m in zip(doc.tolist(), start.tolist(), size.tolist())]
            columns = [
                *[batch.column(c).take(pa.array(doc)) for c in others],
                *[pa.array(x) for x in (start, size, n[doc], sequence, low - sequence * length)],
                pa.array([x.to_pybytes() for x in values], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    done = placed.mapInArrow(cut, T.StructType(fields))
    return done.toDF(*[n for n in names if n != text], *[n for n, _ in added], "tokens")


def sequences(pieces: DataFrame, length: int = SEQUENCE_TOKENS, pad: int = SEPARATOR) -> DataFrame:
    """``(sequence_id, n_tokens, tokens, boundaries)``: whole sequences, padded to ``length``.

    ``boundaries`` are the places where documents' pieces begin. At most ``length`` pieces meet in
    one sequence, as none is empty.
    """
    ordered = F.sort_array(F.collect_list(F.struct("offset", "tokens")))
    whole = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), ordered.alias("p"))
    padding = F.repeat(F.lit(pad.to_bytes(4, "little").hex()), (F.lit(length) - F.col("n_tokens")).cast("int"))
    tokens = F.unhex(F.concat(F.array_join(F.transform("p", lambda x: F.hex(x["tokens"])), ""), padding))
    return whole.select("sequence_id", "n_tokens", tokens.alias("tokens"), F.col("p.offset").alias("boundaries"))

