"""WARC archives with a two-level capture index (operator 12).

Archives are WARC 1.1 files, a gzip member per record. Spark's text sink writes
them: the line separator is the zero byte that ends every member of less than
16 MB (longer records are cut into several members), so Spark's commit protocol
covers lost executors and any gzip or WARC reader takes the files.

The index has two levels. Capture lines, sorted by the reversed-host key of their
URL, lie in compressed blocks of some thousand lines; a sparse directory holds
the first key of each block, cut to 64 bytes, and its place. A search finds the
blocks of a key by binary search in the directory, reads their ranges, and then
the ranges of the records found, in file order.

Scale: payloads are shuffled only where Spark does not broadcast the digests that
occur more than once (they are written first, so it knows their size). Lines are
dealt by key, file and offset, so a host or URL of any weight is split. Blocks
grow with the captures so that the directory keeps to MAX_DIRECTORY entries,
which is what is broadcast.

Of records with equal payloads of at least 100 bytes, the one with the smallest
page_id is the response and the others revisit it.

Defined results: a null html is an empty payload; a null URL has the empty key;
control characters and spaces of a URL are percent-encoded; a null page_id comes
after all others, and revisits; rows that repeat the smallest page_id of their
payload (or payloads without any page_id) are all responses, as there is no
earlier page to refer to; an empty table gives empty archives, index and result;
of other columns only the three named are looked at.

The ranges are read with pyarrow's file systems (local and mounted folders, S3,
GCS, Azure, HDFS with libhdfs), which must reach the shared folder.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridcast.session import materialize, shared_path

#: Payloads shorter than this are never revisited.
LEAST_SHARED = 100
#: Payload bytes in an archive, lines in an index block, entries of the directory, bytes of its keys.
ARCHIVE_BYTES, BLOCK_LINES, MAX_DIRECTORY, KEY_BYTES = 64 << 20, 3000, 200_000, 64
DATE = "2024-01-01T00:00:00Z"
#: Bytes of a record in one gzip member: below 2^24 the last byte of a member is zero.
MEMBER_BYTES = (1 << 24) - 1
#: Bytes read at once when records lie close together, and the gap that is read over.
READ_BYTES, READ_GAP = 8 << 20, 64 << 10

_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- keys -------------------------------------------------------------------

_URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^/?#]*)([^#]*)", re.S)


def _printable(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def capture_key(url: str | None) -> str:
    """Reversed host, then path and query: `https://www.Example.com/a?b#c` is `com,example,www)/a?b`."""
    if not url:
        return ""
    host, rest = _URL.match(_printable(url)).groups()
    host = host.rpartition("@")[2].lower()
    name, _, port = host.partition(":")
    if not re.fullmatch(r"[0-9.]*", name):
        name = ",".join(reversed(name.strip(".").split(".")))
    if not rest.startswith("/"):
        rest = "/" + rest
    return f"{name}{':' + port if port not in ('', '80', '443') else ''}){rest}"


# ---- records ----------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool, date: str = DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit of another page's."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url:
        head.append(f"WARC-Target-URI: {_printable(url)}")
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_REVISIT}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def members(data: bytes) -> bytes:
    """Gzip members of a record, each of less than 16 MB."""
    out = []
    for lo in range(0, max(len(data), 1), MEMBER_BYTES):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += [z.compress(data[lo:lo + MEMBER_BYTES]), z.flush()]
    return b"".join(out)


def _member(raw: memoryview, at: int) -> tuple[bytes, int]:
    """Content of the gzip member at a position, and where the next one begins."""
    z, out, step = zlib.decompressobj(31), [], 1 << 16
    while not z.eof:
        if at >= len(raw):
            raise ValueError("archive ends inside a gzip member")
        part = raw[at:at + step]
        out.append(z.decompress(part))
        at += len(part) - len(z.unused_data)
    return b"".join(out), at


def parse(data: bytes) -> tuple[dict[str, str], bytes | None]:
    """Headers (lower-case names) and block of a record; no block where data does not hold all of it."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.lower(): v.strip(" ") for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    return fields, rest[:n] if len(rest) >= n + 4 else None


def walk(raw: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, headers, block) of the records of an archive or a part of one."""
    view, at = memoryview(raw), 0
    while at < len(view):
        begin = at
        data, at = _member(view, at)
        fields, block = parse(data)
        while block is None:
            more, at = _member(view, at)
            data += more
            fields, block = parse(data)
        yield begin, at - begin, fields, block


def _page(uri: str) -> int | None:
    number = uri.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


# ---- archives ---------------------------------------------------------------

def _write_members(rows: DataFrame, path: str, per_file: int = 0) -> None:
    """Write gzip members, a row each in the binary column `member`, end to end into files under path."""
    rows.select(F.expr("substring(member, 1, octet_length(member) - 1)").cast("string").alias("value")).write.mode("overwrite").options(
        lineSep="\0", compression="none", maxRecordsPerFile=per_file).text(path)


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   archive_bytes: int = ARCHIVE_BYTES, least_shared: int = LEAST_SHARED) -> int:
    """Write a record per page into archives under path; the number of pages."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), html.alias("html"),
                        F.sha2(html, 256).alias("digest"))
    size = F.octet_length("html").cast("long")
    narrow = materialize(rows.select("page_id", F.unhex("digest").alias("digest"), size.alias("size")), "warc-digests")
    shared = materialize(narrow.where(F.col("size") >= least_shared).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select(F.lower(F.hex("digest")).alias("digest"), "first_id"),
        "warc-shared")
    total = narrow.agg(F.count("*").alias("n"), F.coalesce(F.avg("size"), F.lit(0)).alias("mean")).first()
    later = F.col("first_id").isNotNull() & (size >= least_shared) & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id")))
    told = rows.join(shared, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(later, F.col("first_id")).alias("refers_to"), F.coalesce(later, F.lit(False)).alias("revisit"))

    def make(batches):
        for b in batches:
            cols = [b.column(n) for n in ("page_id", "url", "html", "digest", "refers_to", "revisit")]
            for lo in range(0, b.num_rows, 200):
                part = [c.slice(lo, 200).to_pylist() for c in cols]
                yield pa.RecordBatch.from_arrays([pa.array([
                    members(record(i, url, page.encode(), sign, to, again)) for i, url, page, sign, to, again in zip(*part)], pa.binary())],
                    names=["member"])

    _write_members(told.mapInArrow(make, "member binary"), path, max(1, int(archive_bytes // (float(total.mean) + 400))))
    return total.n


# ---- index ------------------------------------------------------------------

def _capture_lines(spark: SparkSession, archives: str) -> DataFrame:
    """(key, file, offset, line) of every record of the archives."""
    def scan(batches):
        for b in batches:
            for path, content in zip(b.column("path").to_pylist(), b.column("content")):
                file = path.rpartition("/")[2]
                keys, offsets, lines = [], [], []
                for offset, length, head, _ in walk(content.as_buffer()):
                    key = capture_key(head.get("warc-target-uri"))
                    date = re.sub("[^0-9]", "", head["warc-date"])
                    said = json.dumps({"page": _page(head["warc-record-id"]), "type": head["warc-type"], "file": file, "offset": offset,
                                       "length": length}, separators=(",", ":"))
                    keys.append(key)
                    offsets.append(offset)
                    lines.append(f"{key} {date} {said}")
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([file] * len(keys), pa.string()),
                                                  pa.array(offsets, pa.int64()), pa.array(lines, pa.string())],
                                                 names=["key", "file", "offset", "line"])

    files = spark.read.format("binaryFile").load(archives).select("path", "content")
    return files.mapInArrow(scan, "key string, file string, offset long, line string")


def write_index(spark: SparkSession, archives: str, path: str, n_captures: int, block_lines: int = BLOCK_LINES,
                max_directory: int = MAX_DIRECTORY) -> None:
    """Sort the captures of the archives by key into compressed blocks under path/blocks, with a directory under path/directory."""
    per_block = max(block_lines, -(-n_captures // max_directory))
    order = ["key", "file", "offset"]
    lines = _capture_lines(spark, archives).repartitionByRange(*order).sortWithinPartitions(*order).select("line")

    def pack(batches):
        held: list[str] = []
        for b in batches:
            held += b.column(0).to_pylist()
            while len(held) >= per_block:
                yield block(held[:per_block])
                del held[:per_block]
        if held:
            yield block(held)

    def block(some: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([members(("\n".join(some) + "\n").encode())], pa.binary())], names=["member"])

    _write_members(lines.mapInArrow(pack, "member binary"), f"{path}/blocks")

    def entries(batches):
        for b in batches:
            for file, content in zip(b.column("path").to_pylist(), b.column("content")):
                raw, at, out = memoryview(content.as_buffer()), 0, []
                while at < len(raw):
                    begin = at
                    data, at = _member(raw, at)
                    first = data.split(b" ", 1)[0]
                    while not data.endswith(b"\n"):  # a block of several members
                        data, at = _member(raw, at)
                    out.append((first[:KEY_BYTES], file, begin, at - begin))
                cols = list(zip(*out)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()),
                                                  pa.array(cols[3], pa.int64())], names=["first", "file", "offset", "length"])

    files = spark.read.format("binaryFile").load(f"{path}/blocks").select("path", "content")
    files.mapInArrow(entries, "first binary, file string, offset long, length long").write.mode("overwrite").parquet(f"{path}/directory")


# ---- searches ---------------------------------------------------------------

def _read_range(open_files: dict, path: str, offset: int, length: int) -> bytes:
    """A range of a file; one file stays open."""
    if path not in open_files:
        from pyarrow.fs import FileSystem
        open_files.clear()
        fs, place = FileSystem.from_uri(re.sub("^s3a:", "s3:", path))
        open_files[path] = fs.open_input_file(place)
    return open_files[path].read_at(length, offset)


def search(urls: DataFrame, index: str, url_col: str = "url") -> DataFrame:
    """Captures of the URLs (by key, each capture once): key, page_id, record_type, file, offset, length."""
    spark = urls.sparkSession
    blocks = sorted((bytes(r.first), r.file, r.offset, r.length)  # bounded by write_index
                    for r in spark.read.parquet(f"{index}/directory").select(F.col("first"), "file", "offset", "length").collect())
    # blocks with equal cut keys may stand in any order: a search takes them all
    shared = spark.sparkContext.broadcast(blocks)

    def find(batches):
        firsts = [b[0] for b in shared.value]
        for b in batches:
            which, keys = [], []
            for key in map(capture_key, b.column(0).to_pylist()):
                cut = key.encode()[:KEY_BYTES]
                for n in range(max(bisect_left(firsts, cut) - 1, 0), bisect_right(firsts, cut)):
                    which.append(n)
                    keys.append(key)
                    if len(keys) == 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(keys, pa.string())], names=["block", "key"])
                        which, keys = [], []
            yield pa.RecordBatch.from_arrays([pa.array(which, pa.int32()), pa.array(keys, pa.string())], names=["block", "key"])

    def read(batches):
        files, now, held, last = {}, None, {}, None
        for b in batches:
            rows = []
            for n, key in zip(b.column("block").to_pylist(), b.column("key").to_pylist()):
                if (n, key) == last:
                    continue
                last = n, key
                if n != now:
                    now, held = n, {}
                    _, file, offset, length = shared.value[n]
                    raw, at = memoryview(_read_range(files, file, offset, length)), 0
                    parts = []
                    while at < len(raw):
                        data, at = _member(raw, at)
                        parts.append(data)
                    for line in b"".join(parts).decode().split("\n")[:-1]:
                        of, _, said = line.split(" ", 2)
                        held.setdefault(of, []).append(said)
                for said in held.get(key, ()):
                    x = json.loads(said)
                    rows.append({"key": key, "page_id": x["page"], "record_type": x["type"], "file": x["file"], "offset": x["offset"],
                                 "length": x["length"]})
            yield pa.RecordBatch.from_pylist(rows, schema=_CAPTURE)

    wanted = urls.select(F.col(url_col).cast("string").alias("url")).distinct().mapInArrow(find, "block int, key string")
    wanted = wanted.repartitionByRange("block", "key").sortWithinPartitions("block", "key")
    return wanted.mapInArrow(read, "key string, page_id long, record_type string, file string, offset long, length long")


_CAPTURE = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("file", pa.string()),
                      ("offset", pa.int64()), ("length", pa.int64())])
_RECORD = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                     ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def fetch(captures: DataFrame, archives: str, payloads: bool = True) -> DataFrame:
    """Read the records of captures by their ranges, in file order: ids, sizes, digests, and payloads of responses if asked for."""
    def spans(batches):
        """(file, first offset, offsets and lengths) of captures that are read at once."""
        file, places = None, []
        for b in batches:
            for f, o, n in zip(b.column("file").to_pylist(), b.column("offset").to_pylist(), b.column("length").to_pylist()):
                if places and (f != file or o > places[-1][0] + places[-1][1] + READ_GAP or o + n > places[0][0] + READ_BYTES):
                    yield file, places
                    places = []
                file = f
                places.append((o, n))
        if places:
            yield file, places

    def read(batches):
        files: dict = {}
        for file, places in spans(batches):
            begin = places[0][0]
            raw = memoryview(_read_range(files, f"{archives}/{file}", begin, places[-1][0] + places[-1][1] - begin))
            rows = []
            for offset, length in places:
                (_, _, head, block), = walk(raw[offset - begin:offset - begin + length])
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = head["warc-payload-digest"].removeprefix("sha256:")
                again = head["warc-type"] == "revisit"
                if not again and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"digest of {head['warc-record-id']} in {file} does not fit its payload")
                said = int(http.rpartition(b"Content-Length:")[2])
                rows.append({"page_id": _page(head["warc-record-id"]), "payload_bytes": said if again else len(payload), "payload_digest": digest,
                             "record_type": head["warc-type"], "refers_to": _page(head["warc-refers-to"]) if again else None,
                             "url": head.get("warc-target-uri"), "payload": payload if payloads and not again else None})
            yield pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    order = ["file", "offset"]
    return captures.select(*order, "length").repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", payloads: bool = False,
                  archive_bytes: int = ARCHIVE_BYTES, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write archives and index of the pages into the shared folder and return all records, found by URL and read back."""
    spark = pages.sparkSession
    path = shared_path(spark, "warc")
    n = write_archives(pages, f"{path}/archives", id_col, url_col, html_col, archive_bytes)
    write_index(spark, f"{path}/archives", f"{path}/index", n, block_lines)
    return fetch(search(pages, f"{path}/index", url_col), f"{path}/archives", payloads)
