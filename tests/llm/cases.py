"""Documents with all that operators must bear, and helpers."""

import random

from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Columns whose names operators use themselves, too.
CLASHING = ["chunk", "rows", "lengths", "marks", "n_words", "n_removed", "bucket", "part", "key"]


def documents(spark, rows, extra=()):
    """Rows of ``(doc_id, text)`` as a documents table, in three partitions."""
    schema = T.StructType([*DOCUMENT.fields, *[T.StructField(n, T.StringType()) for n in extra]])
    values = [(i, t, "en", None, len(t or ""), *["x"] * len(extra)) for i, t in rows]
    frame = spark.createDataFrame(values, schema)
    return frame.repartition(3, "doc_id", "text") if rows else frame


def colliding_words(power=10):
    """Two words of 2 ** power letters that agree in every sum of powers modulo 2**64 (Thue and Morse)."""
    ones = [bin(i).count("1") % 2 for i in range(1 << power)]
    return "".join("ab"[x] for x in ones), "".join("ba"[x] for x in ones)


def prose(seed, n_docs=60, vocabulary=300, longest=120):
    """Random texts with shared passages, exact and near copies, odd spaces and other scripts."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéñß漢") for _ in range(rng.randint(1, 6))) for _ in range(vocabulary)]
    passages = [[rng.choice(words) for _ in range(rng.randint(12, 60))] for _ in range(4)]
    out = []
    for i in range(n_docs):
        own = [rng.choice(words) for _ in range(rng.randint(0, longest))]
        if rng.random() < 0.4:
            at = rng.randint(0, len(own))
            own[at:at] = rng.choice(passages)
        if out and rng.random() < 0.2:
            own = list(rng.choice(out)[1].split())
            if own and rng.random() < 0.7:
                own[rng.randrange(len(own))] = "Zz"
        out.append((i * 3 + 1, rng.choice([" ", "\n", "  "]).join(own)))
    return out


EDGES = [
    (None, "null id one two three"),
    (None, "null id one two three"),
    (7, None),
    (8, ""),
    (9, " \t\n "),
    (10, "x"),
    (11, "x"),
    (12, "ab " * 400),
    (13, "ab " * 400),
    (14, "\x00\x01 odd   bytes \U0001f600"),
    (15, "é" * 3000),
]
