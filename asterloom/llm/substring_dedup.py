"""Exact substring removal by words: every window of words that stands twice goes.

Rabin-Karp hashes of all windows of a fixed number of words are counted in Spark; windows that
repeat are merged into maximal intervals, which are cut out of the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from asterloom.llm import chunks as c
from asterloom.llm import kernels as k

WINDOW_WORDS = 35
#: Hashes that one bucket counts at a time, about.
BUCKET_HASHES = 1_500_000


def windows(chunk: c.Chunk, width: int, buckets: int):
    """Hash, bucket and first word of each window; start, end and text bounds of the words.

    Hash and bucket come from the two halves of a 128-bit hash of each word, rolled with a base
    each, so a mistake takes two windows that agree in 64 bits and in the bucket: with n distinct windows in b
    buckets a probability of about n * n / (b * 2**65), one in 3,000 for 8 billion in 5,600. A window has too few
    words for sums of powers modulo 2**64 to agree by construction.
    """
    starts, ends, bounds = k.words(chunk.data, chunk.offsets, k.NOT_SPACE)
    one, two = k.word_hashes(chunk.data, starts, ends, k.NOT_SPACE).T
    counts = np.diff(bounds)
    at = k.ranges(bounds[:-1], np.maximum(counts - width + 1, 0))
    values = k.mix(k.Rolling(one)(at, at + width))
    other = k.mix(k.Rolling(two, 1)(at, at + width), 2)
    return values, (other % k.U(buckets)).astype(np.int64), at, (starts, ends, bounds)


def remove_repeated_windows(
    docs: DataFrame, text: str = "text", width: int = WINDOW_WORDS, bucket_hashes: int = BUCKET_HASHES
) -> DataFrame:
    """The documents without the words that lie in a window of words standing twice or more.

    Words are runs of characters other than space and 09 to 0D, compared as they are. A window is
    ``width`` consecutive words of one document; its other occurrence may be in the same document,
    also overlapping. All windows are judged on the input. Added columns: ``n_words``, ``n_removed``,
    ``removed`` (maximal intervals of words, ``[first, end)``) and ``kept_text`` (kept words joined
    by one space). Null and empty texts have no words and an empty ``kept_text``; repeated rows are
    documents of their own; an empty table gives an empty table.

    The hashes of a chunk are sent once each, so a window that stands in a third of all documents
    costs its bucket one value per chunk.
    """
    total = c.text_bytes(docs, text)
    buckets = max(48, -(-total // (6 * bucket_hashes)))
    frame, names = c.by_position(docs)
    here = f"c{names.index(text)}"
    chunks = c.write_chunks(frame, here)
    marks = c.repeated(chunks, lambda chunk: windows(chunk, width, buckets)[:2], buckets)

    def cut(chunk, batch, i):
        values, at_bucket, at, (starts, ends, bounds) = windows(chunk, width, buckets)
        again = c.is_repeated(values, at_bucket, buckets, batch.column("marks")[i])
        gone = k.covered(len(starts), at[again], width)
        firsts, lasts = k.runs(gone, bounds)
        n_removed = k.sums_between(gone, bounds)
        by_doc = np.searchsorted(firsts, bounds)
        kept = []
        for d in range(len(chunk.lengths)):
            own = chunk.text(d).split()
            if n_removed[d]:
                spans = zip(firsts[by_doc[d] : by_doc[d + 1]], lasts[by_doc[d] : by_doc[d + 1]])
                for a, b in reversed(list(spans)):
                    del own[a - bounds[d] : b - bounds[d]]
            kept.append(b" ".join(own))
        lists = np.stack([firsts, lasts], 1) - bounds[np.searchsorted(bounds, firsts, "right") - 1][:, None]
        pairs = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(lists) + 1, 2), pa.int32()), pa.array(lists.ravel(), pa.int64()))
        return [
            pa.array(np.diff(bounds)),
            pa.array(n_removed),
            pa.ListArray.from_arrays(pa.array(by_doc, pa.int32()), pairs),
            pa.array(kept, pa.binary()).cast(pa.string()),
        ]

    out = c.unpack(
        c.with_marks(chunks, marks),
        cut,
        [
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType()))),
            T.StructField("kept_text", T.StringType()),
        ],
    )
    return out.toDF(*[n for n in names if n != text], "n_words", "n_removed", "removed", "kept_text")
