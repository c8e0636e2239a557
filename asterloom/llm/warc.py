"""WARC archives of pages, and an index of their captures in the order of URL key and time.

Archives are WARC 1.1 files, each one gzip stream, that Spark writes and reads back. The index is
an external merge: captures are sorted in runs where they are read, the runs are dealt by ranges
of the key, and a loser tree merges the runs of each range.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asterloom.llm.chunks import by_position, stage
from asterloom.sinks.scratch import new_scratch_dir

#: Smaller payloads are written in full each time.
REVISIT_BYTES = 100
EPOCH = "2024-01-01 00:00:00"
#: Seconds over which the default capture times are spread.
YEAR = 366 * 86_400
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Records of an archive file at most. A file is read by one task: line readers can lose a record
#: where a split ends in a separator of several bytes.
FILE_RECORDS = 50_000
#: Captures of a sorted run.
RUN_ROWS = 20_000
#: Captures of a key range, about: a task merges a range in memory.
RANGE_ROWS = 200_000


@dataclass(frozen=True)
class Archives:
    """Where the archives are, and the id that each of their records names."""

    path: str
    info: str

    @property
    def opening(self) -> str:
        """How each record begins. No payload can hold it, as the id is newer than the payloads."""
        return f"WARC/1.1{CRLF}WARC-Warcinfo-ID: <urn:uuid:{self.info}>{CRLF}"


def _uuid(*values) -> Column:
    """A name-based record id."""
    h = F.md5(F.concat_ws("|", *values))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _header(name: str, value) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def repeats(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``(key, digest, first)``: the pages that repeat a payload, and the smallest key that has it.

    Only keys and digests are shuffled. The smallest keys come from partial minima, and the join
    can be split where one payload has very many pages.
    """
    large = pages.filter(F.col("payload_bytes") >= least).select("key", "digest")
    first = large.groupBy("digest").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    first = first.filter("n > 1 AND first IS NOT NULL").select(F.col("digest").alias("same"), "first")
    found = large.join(first, F.col("digest") == F.col("same"))
    return found.filter(F.col("key").isNull() | (F.col("key") != F.col("first"))).select("key", "digest", "first").distinct()


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", captured: Column | None = None) -> Archives:
    """Write a WARC record per page; the payload is the html in UTF-8 (null: empty).

    Of pages with equal payloads of at least 100 bytes, that with the smallest key becomes a
    response record, the others revisit records without payload that refer to it; smaller payloads
    are always responses. Rows that share the smallest key are all responses. Control characters
    in urls are percent-encoded; a null url is written as an empty target. ``captured`` is the
    capture time, by default one second per key after the start of 2024.

    Which pages repeat a payload is written first, so that the payloads themselves are shuffled
    only if the list of repeats is too large to be sent to all tasks.
    """
    if captured is None:
        second = F.pmod(F.coalesce(F.col(f"`{key}`").cast("long"), F.lit(0)), F.lit(YEAR))
        captured = F.timestamp_seconds(F.unix_timestamp(F.lit(EPOCH)) + second)
    archives = Archives(path, str(uuid.uuid4()))
    payload = F.make_valid_utf8(F.coalesce(F.col(f"`{html}`"), F.lit("")))
    target = F.make_valid_utf8(F.coalesce(F.col(f"`{url}`"), F.lit("")))
    target = F.regexp_replace(F.regexp_replace(F.regexp_replace(target, "\r", "%0D"), "\n", "%0A"), "\u0000", "%00")
    rows = pages.select(
        F.col(f"`{key}`").cast("long").alias("key"),
        target.alias("target"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha2(F.encode(payload, "utf-8"), 256).alias("digest"),
        F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("time"),
    )
    again = stage(repeats(rows), "repeats").toDF("repeat_key", "repeat_digest", "first")
    joined = rows.join(again, F.col("key").eqNullSafe(F.col("repeat_key")) & (F.col("digest") == F.col("repeat_digest")), "left")
    revisit = F.col("first").isNotNull()
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        _header("Content-Length", F.col("payload_bytes")),
        F.lit(CRLF),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    name = F.coalesce(F.col("key").cast("string"), F.lit(""))
    record = F.concat(
        F.lit(archives.opening),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _uuid(F.lit(archives.info), name)),
        _header("WARC-Date", F.col("time")),
        _header("WARC-Target-URI", F.col("target")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _header("X-Payload-Length", F.col("payload_bytes")),
        _header("X-Capture-Key", name),
        F.when(
            revisit,
            F.concat(
                _header("WARC-Profile", F.lit(PROFILE)),
                _header("WARC-Refers-To", _uuid(F.lit(archives.info), F.col("first").cast("string"))),
                _header("X-Refers-To-Key", F.col("first").cast("string")),
            ),
        ).otherwise(""),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
        _header("Content-Length", F.octet_length(block)),
        F.lit(CRLF),
        block,
    )
    out = joined.select(record.alias("value")).write.option("lineSep", CRLF * 2)
    out.option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)
    return archives


def read_archives(spark: SparkSession, archives: Archives) -> DataFrame:
    """The records of archives: type, key, url, time, digest, length, reference and payload.

    Files are cut at the openings of records, which no payload holds. The length of
    each block is checked against its header, and the payload of each response against its digest;
    a record that fails is an error.
    """
    rows = spark.read.option("lineSep", CRLF * 2 + archives.opening).text(archives.path)
    value = F.col("value")
    # The first record of a file still has its opening, the last one its final line ends.
    value = F.when(value.startswith(archives.opening), F.substring(value, len(archives.opening) + 1, 2**31 - 1)).otherwise(value)
    rows = rows.select(value.alias("value")).withColumn("head", F.substring_index("value", CRLF * 2, 1))

    def header(name):
        return F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)", 1)

    def number(name):
        return F.when(header(name) != "", header(name).cast("long"))

    parsed = rows.select(
        header("WARC-Type").alias("record_type"),
        number("X-Capture-Key").alias("key"),
        header("WARC-Target-URI").alias("url"),
        header("WARC-Date").alias("time"),
        F.regexp_extract("head", r"(?m)^WARC-Payload-Digest: sha256:([0-9a-f]*)", 1).alias("payload_digest"),
        number("X-Payload-Length").alias("payload_bytes"),
        number("X-Refers-To-Key").alias("refers_to"),
        number("Content-Length").alias("block_bytes"),
        F.encode(F.expr("substring(value, char_length(head) + 5)"), "utf-8").alias("block"),
    )
    parsed = parsed.withColumn("rest", F.expr("substring(block, block_bytes + 1)")).withColumn("block", F.expr("substring(block, 1, block_bytes)"))
    payload = F.expr(f"substring(block, instr(decode(block, 'utf-8'), '{CRLF * 2}') + 4)")
    response = F.col("record_type") == "response"
    parsed = parsed.withColumn("payload", F.when(response, payload))
    whole = (F.octet_length("block") == F.col("block_bytes")) & F.decode("rest", "utf-8").isin("", CRLF, CRLF * 2)
    right = ~response | (F.sha2("payload", 256) == F.col("payload_digest")) & (F.octet_length("payload") == F.col("payload_bytes"))
    checked = F.when(whole & right, F.col("record_type")).otherwise(F.raise_error(F.concat(F.lit("damaged record: "), "url")))
    return parsed.withColumn("record_type", checked).drop("rest", "block", "block_bytes")


def url_key(url: str | Column) -> Column:
    """The sort key of a URL: host labels backwards, then path and query, all in lower case."""
    u = F.lower(F.col(url) if isinstance(url, str) else url)
    bare = F.regexp_replace(F.regexp_replace(u, r"^[a-z][a-z0-9+.-]*://", ""), r"#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r"^(?:[^@]*@)?(?:www\d*\.)?", ""), r":(?:80|443)?$", "")
    rest = F.regexp_extract(bare, r"^[^/?]*(.*)$", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest))


class LoserTree:
    """Merges sorted runs: each inner node keeps the loser of its match, the top the winner."""

    def __init__(self, runs: list[Iterator]):
        self.runs = [iter(r) for r in runs]
        self.k = max(1, len(self.runs))
        self.heads = [next(r, None) for r in self.runs] or [None]
        self.losers = [-1] * self.k
        for i in range(self.k):
            self.play(i)

    def less(self, a: int, b: int) -> bool:
        if self.heads[a] is None or self.heads[b] is None:
            return self.heads[a] is not None and self.heads[b] is None
        return self.heads[a] < self.heads[b] if self.heads[a] != self.heads[b] else a < b

    def play(self, i: int) -> None:
        node, winner = (i + self.k) // 2, i
        while node > 0:
            other = self.losers[node]
            if other == -1:  # the first one here waits for its rival
                self.losers[node] = winner
                return
            if self.less(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while (value := self.heads[i := self.losers[0]]) is not None:
            yield value
            self.heads[i] = next(self.runs[i], None)
            self.play(i)


def capture_index(captures: DataFrame, key: str, url: str, time: str, parts: int | None = None) -> DataFrame:
    """The captures in global order of URL key, time and key: ``part`` and ``place`` tell the order.

    Rows are ordered by part, and in a part by place. Each task that reads captures sorts them in
    runs; the runs are cut at sampled bounds of the whole sort key, so the captures of one URL may
    go to many parts, and each part merges its pieces of runs by a loser tree. Without ``parts`` there are
    as many as shuffle partitions, or more, so that a part has about ``RANGE_ROWS`` captures at most. Null urls, times and keys
    come first; repeated rows stay. Added columns: ``url_key``, ``part`` and ``place``.
    """
    frame, names = by_position(captures)
    k, u, t = (f"c{names.index(n)}" for n in (key, url, time))
    order = ["url_key", "time_key", "row_key"]
    keyed = frame.select(
        F.coalesce(url_key(u), F.lit("")).alias("url_key"),
        F.coalesce(F.col(t).cast("string"), F.lit("")).alias("time_key"),
        F.coalesce(F.col(k).cast("long"), F.lit(-(2**63))).alias("row_key"),
        F.struct(*frame.columns).alias("row"),
    )
    kind = keyed.schema["row"].dataType.simpleString()

    def sort_runs(batches):
        from pyspark import TaskContext

        run = TaskContext.get().partitionId() << 32
        for batch in _batches_of(batches, RUN_ROWS):
            batch = batch.sort_by([(n, "ascending") for n in order])
            batch = batch.append_column("run", pa.array([run] * len(batch), pa.int64()))
            run += 1
            yield from batch.combine_chunks().to_batches(max_chunksize=2000)

    runs = stage(keyed.mapInArrow(sort_runs, f"url_key string, time_key string, row_key long, row {kind}, run long"), "runs")
    n = parts or max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-runs.count() // RANGE_ROWS))
    ranged = runs.repartitionByRange(n, *order)

    def merge(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        table = pa.Table.from_batches(list(batches), schema=None) if (batches := list(batches)) else None
        if table is None or len(table) == 0:
            return
        keys = list(zip(*[table.column(c).to_pylist() for c in order]))
        pieces: dict[int, list[list[int]]] = {}
        for i, run in enumerate(table.column("run").to_pylist()):
            own = pieces.setdefault(run, [[]])
            if own[-1] and keys[own[-1][-1]] > keys[i]:  # a piece that did not arrive in order is two
                own.append([])
            own[-1].append(i)
        tree = LoserTree([((keys[i], i) for i in piece) for own in pieces.values() for piece in own])
        merged = table.take(pa.array([i for _, i in tree], pa.int64())).select(["url_key", "row"])
        merged = merged.append_column("part", pa.array([part] * len(merged), pa.int64()))
        merged = merged.append_column("place", pa.array(range(len(merged)), pa.int64()))
        yield from merged.combine_chunks().to_batches(max_chunksize=2000)

    merged = ranged.mapInArrow(merge, f"url_key string, row {kind}, part long, place long")
    return merged.select("row.*", "url_key", "part", "place").toDF(*names, "url_key", "part", "place")


def _batches_of(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write pages to archives in the shared folder, read these back, and index the captures.

    Returns the index: key, url, time, ``payload_bytes`` and ``payload_digest`` (of the full
    payload, also for revisits), ``record_type``, ``refers_to`` (the key of the response that a
    revisit refers to), ``url_key``, ``part`` and ``place``; other columns are not kept. An empty
    table gives an empty index. Keys that are no integers are an error; html that is not UTF-8 is written as ``write_archives`` tells.
    """
    spark = pages.sparkSession
    frame, names = by_position(pages)
    k, u, h = (f"c{names.index(n)}" for n in (key, url, html))
    archives = write_archives(frame, new_scratch_dir(spark, "warc"), k, u, h)
    records = read_archives(spark, archives).drop("payload")
    return capture_index(records, "key", "url", "time").withColumnRenamed("key", key)
