import gzip
import hashlib
import heapq
import random

import pytest

from asterloom.llm import warc as w
from tests.llm.test_html_text import PAGE

LONG = "<p>" + "x\r\n\r\nWARC/1.1\r\n" * 20
ROWS = [
    (5, "http://B.example.com/x?q=1", LONG),
    (3, "https://www.a.example.com:443/", LONG),
    (9, "http://a.example.com/z", LONG),
    (4, "u", "short"),
    (6, "u", "short"),
    (7, None, None),
    (8, "", ""),
    (10, "http://a/\r\nb", "é" * 50),
    (11, "http://a/\nb", "é" * 50),
    (12, "x", "\r\n\r\n" * 30),
    (13, "x", "a" * 100 + "\r\n\r\n"),
    (14, "x", "a" * 100 + "\r\n"),
    (15, "x", "\r\n" + "b" * 99999),
    (16, "x", "\U0001f600\x00" * 40),
]


def brute(rows):
    first = {}
    for i, _, t in rows:
        if len((t or "").encode()) >= 100:
            first[t] = min(first.get(t, i), i)
    out = []
    for i, _, t in rows:
        b = (t or "").encode()
        kind = "revisit" if first.get(t, i) != i else "response"
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), kind, first[t] if kind == "revisit" else None))
    return sorted(out)


COLUMNS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def test_same_as_brute_force(spark):
    rows = ROWS + [(100 + i, f"http://h{i % 7}.example.org/{i % 3}", LONG if i % 3 else f"<p>{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, PAGE).selectExpr("*", "'k' AS key", "'d' AS digest").repartition(5)
    out = w.archive_pages(pages)
    assert sorted(tuple(r) for r in out.select(*COLUMNS).collect()) == brute(rows)
    ordered = sorted(out.collect(), key=lambda r: (r.part, r.place))
    keys = [(r.url_key, r.time, r.page_id) for r in ordered]
    assert keys == sorted(keys) and len({r.part for r in ordered}) > 1


def test_null_and_repeated_keys(spark):
    pages = spark.createDataFrame([(None, "u", LONG), (2, "u", LONG), (2, "u", LONG), (None, "v", "a")], PAGE)
    out = sorted(tuple(r) for r in w.archive_pages(pages).selectExpr("coalesce(page_id, -1)", "record_type", "coalesce(refers_to, -1)").collect())
    assert out == [(-1, "response", -1), (-1, "revisit", 2), (2, "response", -1), (2, "response", -1)]
    assert w.archive_pages(spark.createDataFrame([], PAGE)).collect() == []


@pytest.mark.parametrize("split", ["128m", "200b"])
def test_payloads_survive(spark, with_conf, tmp_path, split):
    with_conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="1b")
    rng = random.Random(3)
    pieces = ["\r\n", "\r", "\n", "\r\n\r\nWARC/1.1\r\n", "é", "x" * 50]
    more = [(1000 + i, "u", f"{i}" + "".join(rng.choice(pieces) for _ in range(rng.randint(0, 400)))) for i in range(1500)]
    archives = w.write_archives(spark.createDataFrame(ROWS + more, PAGE).repartition(3), f"{tmp_path}/a")
    read = w.read_archives(spark, archives).filter("record_type = 'response'")
    kept = {i for i, _, _, kind, _ in brute(ROWS + more) if kind == "response"}
    expected = sorted((i, (t or "").encode()) for i, _, t in ROWS + more if i in kept)
    assert sorted((r.key, bytes(r.payload)) for r in read.collect()) == expected


def test_records_follow_the_format(spark, tmp_path):
    w.write_archives(spark.createDataFrame(ROWS[:4], PAGE).coalesce(1), f"{tmp_path}/a")
    (file,) = (tmp_path / "a").glob("part-*")
    data, seen = gzip.decompress(file.read_bytes()), 0
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and lines[b"WARC-Record-ID"].startswith(b"<urn:uuid:")
        size = int(lines[b"Content-Length"])
        assert rest[size : size + 4] == b"\r\n\r\n"
        data, seen = rest[size + 4 :], seen + 1
    assert seen == 4


def test_damage_is_an_error(spark, tmp_path):
    archives = w.write_archives(spark.createDataFrame(ROWS[:1], PAGE), f"{tmp_path}/a")
    (file,) = [f for f in (tmp_path / "a").glob("part-*") if gzip.decompress(f.read_bytes())]
    file.write_bytes(gzip.compress(gzip.decompress(file.read_bytes()).replace(b"<p>x", b"<p>y")))
    for crc in (tmp_path / "a").glob(".*.crc"):
        crc.unlink()
    with pytest.raises(Exception, match="damaged record"):
        w.read_archives(spark, archives).collect()


@pytest.mark.parametrize("seed", range(12))
def test_loser_tree(seed):
    rng = random.Random(seed)
    runs = [sorted(rng.randrange(50) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(0, 9))]
    assert list(w.LoserTree([iter(r) for r in runs])) == list(heapq.merge(*runs))


def test_url_keys(spark):
    urls = ["https://www.A.example.com:443/X?b=1#f", "http://example.com", "http://u@h.org:8080/p", ""]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(w.url_key("u").alias("k")).collect()
    assert [r.k for r in rows] == ["com,example,a)/x?b=1", "com,example)/", "org:8080,h)/p", ")/"]


def test_ranges_grow_with_the_captures(spark, monkeypatch):
    monkeypatch.setattr(w, "RANGE_ROWS", 20)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    captures = spark.range(60 * n).selectExpr("id", "concat('http://a.org/', id) AS url", "'2024' AS time")
    rows = w.capture_index(captures, "id", "url", "time").collect()
    assert len(rows) == 60 * n and len({r.part for r in rows}) > 2 * n
    assert [r.url_key for r in sorted(rows, key=lambda r: (r.part, r.place))] == sorted(r.url_key for r in rows)


def test_keys_of_any_size(spark):
    html = "x" * 200
    rows = [(10**13, "http://a/", html), (2**62, "http://a/", html), (-(2**62), "http://b/", html), (None, "http://c/", html), (2**63 - 1, None, "")]
    out = w.archive_pages(spark.createDataFrame(rows, PAGE))
    assert sorted((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to) for r in out.collect()) == [
        (False, -(2**62), "response", None),
        (False, 10**13, "revisit", -(2**62)),
        (False, 2**62, "revisit", -(2**62)),
        (False, 2**63 - 1, "response", None),
        (True, 0, "revisit", -(2**62)),
    ]
    assert {r.time[:4] for r in out.collect()} == {"2024"}


def test_bytes_that_are_not_utf8(spark):
    frame = spark.sql("SELECT 1L AS page_id, cast(X'687474703A2F2FFF' AS string) AS url, cast(X'FF6162' AS string) AS html")
    (row,) = w.archive_pages(frame).collect()
    payload = "\ufffdab".encode()
    assert (row.payload_bytes, row.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
    assert row.url == "http://\ufffd"
