"""Operator 12: round trip, the index against a plain scan, archives against a plain gzip reader."""

import gzip
import hashlib
import os
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridcast.llm import warc as w
from gridcast.session import shared_path

SCHEMA = "page_id long, url string, html string"
COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def brute(rows):
    first = {}
    for i, _, h in rows:
        h = (h or "").encode()
        if len(h) >= 100:
            seen = first.setdefault(h, (None, 0))
            ids = [x for x in (seen[0], i) if x is not None]
            first[h] = (min(ids) if ids else None, seen[1] + 1)
    out = []
    for i, _, h in rows:
        h = (h or "").encode()
        to, n = first.get(h, (None, 0))
        again = n > 1 and to is not None and (i is None or i > to)
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def pages(n=300, seed=0):
    rng = random.Random(seed)
    body = ["<p>" + "".join(rng.choice("abcé😀 \r\n") for _ in range(rng.randint(60, 400))) + "</p>" for _ in range(n // 4)]
    urls = [f"http{rng.choice(['', 's'])}://{rng.choice(['www.', '', 'm.'])}h{rng.randrange(9)}.example.com/{rng.randrange(40)}?q={rng.randrange(2)}"
            for _ in range(n)]
    return [(i, urls[i], rng.choice(body) if rng.random() < 0.6 else rng.choice(body) + str(i)) for i in range(n)]


def check(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = w.archive_pages(df, **options).select(*COLUMNS).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_equal_to_brute_force(spark):
    rows = pages()
    hot = "<html>" + "same page " * 40
    rows += [(1000 + i, "http://hot.example.org/", hot) for i in range(200)]  # one host, URL and payload in two fifths of the rows
    check(spark, rows)
    check(spark, rows, archive_bytes=20_000, block_lines=7)


def test_odd_rows(spark):
    long = "x" * 120
    rows = [(1, None, None), (2, "", ""), (3, "http://a.b/ c\r\nX: y", long), (3, "http://a.b/ c\r\nX: y", long), (None, "http://a.b/", long),
            (None, None, "z" * 200), (None, None, "z" * 200), (4, "http://a.b/é#frag", "y" * 99), (5, "HTTP://A.B:80/é", "y" * 99), (6, "not a url", long),
            (-7, "http://" + "k" * 300 + ".c/", long), (8, "http://" + "k" * 300 + ".c/", "\r\n\r\nWARC/1.1\r\n\r\n" * 9)]
    check(spark, rows)
    check(spark, rows, block_lines=1)
    clash = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("q").alias(n) for n in ("key", "file", "digest", "member", "size", "first_id")))
    assert w.archive_pages(clash).count() == len(rows)
    assert w.archive_pages(spark.createDataFrame([], SCHEMA)).select(*COLUMNS).collect() == []


def test_search_and_files(spark):
    rows = pages(400, 3)
    path = shared_path(spark, "warc-test")
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    n = w.write_archives(df, f"{path}/a", archive_bytes=30_000)
    assert n == 400
    # the archives are plain gzip WARC files; a plain reader finds every payload
    files = [os.path.join(f"{path}/a", f) for f in os.listdir(f"{path}/a") if f.startswith("part-")]
    assert len(files) > 4
    text = b"".join(gzip.open(f).read() for f in files)
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == 400
    w.write_index(spark, f"{path}/a", f"{path}/i", n, block_lines=10)
    wanted = [rows[5][1], rows[77][1], "http://nowhere.example.com/", None]
    keys = {w.capture_key(u) for u in wanted}
    found = w.search(spark.createDataFrame([(u,) for u in wanted + wanted], "url string"), f"{path}/i")
    read = w.fetch(found, f"{path}/a").collect()
    want = {r[0]: r[2].encode() for r in rows if w.capture_key(r[1]) in keys}
    assert sorted(r.page_id for r in read) == sorted(want) and len(want) >= 2
    assert all(bytes(r.payload) == want[r.page_id] for r in read if r.record_type == "response")
    # the directory stays within its bound: blocks grow
    w.write_index(spark, f"{path}/a", f"{path}/j", n, block_lines=1, max_directory=20)
    assert spark.read.parquet(f"{path}/j/directory").count() <= 20 + 4


def test_a_record_of_several_members(spark, monkeypatch):
    data = w.record(1, "http://a.b/", os.urandom(5000).hex().encode(), "0", None, False)
    monkeypatch.setattr(w, "MEMBER_BYTES", 1000)
    both = w.members(data) + w.members(data)
    got = list(w.walk(both))
    assert len(got) == 2 and got[1][0] == got[0][1] and got[0][3] == got[1][3] and len(got[0][3]) > 10_000
    assert all(both[i] == 0 for i in (got[0][1] - 1, len(both) - 1))


def test_keys():
    for url, key in (("https://www.Example.com/a?b#c", "com,example,www)/a?b"), ("http://user@x.org:8080", "org,x:8080)/"), ("http://x.org:80?q", "org,x)/?q"),
                     ("http://10.0.0.1/a b", "10.0.0.1)/a%20b"), (None, ""), ("", "")):
        assert w.capture_key(url) == key


@settings(max_examples=100, deadline=None, database=None, derandomize=True)
@given(st.text(), st.binary(), st.one_of(st.none(), st.integers(-9, 9)), st.booleans())
def test_records_round_trip(url, payload, page_id, again):
    url = url.encode("utf-8", "replace").decode()
    data = w.members(w.record(page_id, url, payload, "d", 4, again))
    assert data[-1] == 0
    (_, length, head, block), = w.walk(data)
    assert length == len(data) and w._page(head["warc-record-id"]) == page_id
    assert block.endswith(b"\r\n\r\n" if again else b"\r\n\r\n" + payload)
    assert " " not in w.capture_key(head.get("warc-target-uri")) and w.capture_key(head.get("warc-target-uri")) == w.capture_key(url)
