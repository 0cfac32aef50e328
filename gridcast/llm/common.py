"""Shared helpers of the training-data operators: words, rolling hashes, batches.

A *word* is a run of bytes other than 0x20 and 0x09-0x0D, which is what
`bytes.split()` yields. All hashes are 64-bit; callers that need exact
results compare the words behind equal hashes.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

U64 = np.uint64
#: Odd multiplier of the polynomial rolling hash.
BASE = U64(0x9E3779B97F4A7C15)
#: Bytes of text that a task turns into arrays at once.
CHUNK_BYTES = 6 << 20
#: Rows in an Arrow batch: keeps batches of long texts small.
ARROW_ROWS = 1000

WORD_RE = r"[^\x20\x09-\x0D]+"
#: Stands for a null id where ids are ordered: before all others.
NULL_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of the Arrow batches that tasks receive."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, with leading underscores until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def worker_state(key: str, make):
    """A value kept for the life of a Python worker process, across its tasks."""
    holder = sys.modules.setdefault("_gridcast_worker_state", types.ModuleType("_gridcast_worker_state"))
    if not hasattr(holder, key):
        setattr(holder, key, make())
    return getattr(holder, key)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about max_bytes of text; a longer text comes alone."""
    for b in batches:
        n = b.num_rows
        if n == 0:
            continue
        size = pc.binary_length(b.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        piece = np.cumsum(size) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), n]
        for lo, hi in zip(cuts, cuts[1:]):
            yield b.slice(lo, hi - lo)


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8; null becomes the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


#: Which bytes part words.
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def word_column(texts: list[bytes]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of texts end to end, each with one space after it, and the first word of each text (and the total).

    The values of the array are one buffer: the words with single spaces.
    """
    line = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = _SPACE[line]
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    last = np.flatnonzero(space[1:] & ~space[:-1]) + 1  # the space after each word
    starts = np.searchsorted(last, np.concatenate([[0], ends]))
    keep = ~space
    keep[last] = True
    line, space = line[keep], space[keep]
    line = np.where(space, np.uint8(0x20), line)
    offsets = np.concatenate([[0], np.flatnonzero(space) + 1])
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(last), [None, pa.py_buffer(offsets), pa.py_buffer(line)]), starts


#: The low bytes of a word of 8; words up to LONG bytes are hashed 8 bytes at a time.
_LOW, LONG = np.array([(1 << 8 * n) - 1 for n in range(9)], U64), 64


class Words:
    """The words of several texts, end to end.

    starts: first word of each text (and the total); line, place: the words, each
    with a space after it, and where each begins (and the total). When asked for:
    flat, the words; ids, int32 per word into the distinct words, vocab; hashes
    and quick, two 64-bit hashes per word position, the second without a vocabulary.
    """

    def __init__(self, texts: list[bytes]):
        column, self.starts = word_column(texts)
        self.place, self.line = np.frombuffer(column.buffers()[1], np.int64), column.buffers()[2].to_pybytes()

    @cached_property
    def _coded(self) -> pa.DictionaryArray:
        parts = [None, pa.py_buffer(self.place), pa.py_buffer(self.line)]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self), parts).dictionary_encode()

    @cached_property
    def flat(self) -> list[bytes]:
        return self.line.split(b" ")[:-1]

    @cached_property
    def ids(self) -> np.ndarray:
        return self._coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)

    @cached_property
    def vocab(self) -> list[bytes]:
        distinct = self._coded.dictionary  # each with its space, so that one cut parts them all
        end = np.frombuffer(distinct.buffers()[1], np.int64)[len(distinct)]
        return distinct.buffers()[2].to_pybytes()[:end].split(b" ")[:-1]

    @cached_property
    def hashes(self) -> np.ndarray:
        own = np.fromiter(map(xxhash.xxh64_intdigest, self.vocab), U64, len(self.vocab))
        return own[self.ids] if len(self.vocab) else np.zeros(0, U64)

    @cached_property
    def quick(self) -> np.ndarray:
        begin, size = self.place[:-1], np.diff(self.place) - 1
        h = size.astype(U64) * BASE
        eight = np.ndarray(len(self.line) + 1, "<u8", self.line + bytes(8), strides=(1,))  # the 8 bytes from each one on
        at, done = np.flatnonzero(size <= LONG), 0
        while len(at):
            x = h[at] ^ (eight[begin[at] + done] & _LOW[np.minimum(size[at] - done, 8)])
            h[at] = scramble(x)
            done += 8
            at = at[size[at] > done]
        for i in np.flatnonzero(size > LONG).tolist():
            h[i] = xxhash.xxh64_intdigest(self.line[begin[i]:begin[i] + size[i]])
        return h

    def __len__(self) -> int:
        return len(self.place) - 1

    def doc_of(self) -> np.ndarray:
        """Text number of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def window_starts(self, n: int) -> np.ndarray:
        """Positions where n words of one text begin."""
        ends = np.repeat(self.starts[1:], np.diff(self.starts))
        return np.flatnonzero(np.arange(len(self)) + n <= ends)


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of each n consecutive values (len - n + 1 of them), by doubling."""
    if len(hashes) < n:
        return np.zeros(0, U64)
    out, done, part, size, power = None, 0, hashes, 1, BASE
    left = n
    while left:
        if left & 1:
            if out is None:
                out, done = part.copy(), size
            else:  # out covers `done` values, part the next `size`
                m = len(hashes) - (done + size) + 1
                out = out[:m] * power + part[done:done + m]
                done += size
        left >>= 1
        if left:
            m = len(hashes) - 2 * size + 1
            part = part[:m] * power + part[size:size + m]
            power = U64(int(power) ** 2 & 0xFFFFFFFFFFFFFFFF)
            size *= 2
    return out


def scramble(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads a hash over all 64 bits."""
    h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def sliding_min(h: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    part, size = h, 1
    while size * 2 <= w:
        part = np.minimum(part[:len(part) - size], part[size:])
        size *= 2
    rest = w - size
    return np.minimum(part[:len(part) - rest], part[rest:]) if rest else part


def covered(positions: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of `total` words lie in a window of n words at one of the positions."""
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, positions, 1)
    np.add.at(edge, positions + n, -1)
    return np.cumsum(edge[:-1]) > 0


def doc_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, under fixed names."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


#: Slots of the sketch of n-gram counts, whatever the corpus; a slot this many
#: times as full as the mean is frequent.
SLOTS, FREQUENT = 1 << 16, 8


def frequent_slots(docs: DataFrame, n: int) -> tuple[np.ndarray, int]:
    """Which slots of scrambled n-gram hashes are frequent over all documents, and how many n-grams there are.

    The sketch only orders work; no result depends on it.
    """
    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for b in text_slices(batches, "text"):
            words = Words(as_bytes(b.column("text")))
            h = scramble(rolling(words.quick, n))[words.window_starts(n)]
            total += np.bincount((h & U64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["slot", "n"])

    full = np.zeros(SLOTS, np.int64)
    rows = docs.select("text").mapInArrow(count, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    for b in rows.toArrow().to_batches():  # a row per slot at most
        full[b.column(0).to_numpy(zero_copy_only=False)] = b.column(1).to_numpy(zero_copy_only=False)
    return full > FREQUENT * max(1.0, full.mean()), int(full.sum())


#: Times the rows wanted of a kind that its hash range should hold.
SPARE = 8


def text_sample(docs: DataFrame, max_rows: int, max_chars: int, kinds: DataFrame | None = None) -> DataFrame:
    """A bounded sample of texts per kind: (kind, id, text), at most max_rows rows and max_chars characters of a kind.

    docs: id, text, and kind unless `kinds` (id, kind) tells it. Rows equal in
    kind, id and text count once; the first ones in the order of a 64-bit hash of
    id and text are taken, until the characters are spent. Texts longer than
    max_chars, and rows without a text or kind, are left out; a null id is an id.
    Only hashes and lengths are ranked, and only those in a hash range that holds
    a few times max_rows distinct ones.
    """
    spark = docs.sparkSession
    said = [F.coalesce(F.col("id").cast("string"), F.lit("")), F.col("id").isNull(), F.col("text")]
    keyed = docs.where(F.col("text").isNotNull()).withColumns({"key1": F.xxhash64(*said), "key2": F.xxhash64(F.lit(1), *said)})
    narrow = keyed.select("id", "key1", "key2", F.length("text").alias("n"), *(["kind"] if kinds is None else [])).where(F.col("n") <= max_chars)
    narrow = narrow if kinds is None else narrow.join(kinds.select("id", "kind"), "id")
    narrow = narrow.where(F.col("kind").isNotNull())
    sizes = narrow.groupBy("kind").agg(F.approx_count_distinct("key1").alias("rows"))
    ranges = spark.createDataFrame([(r["kind"], min(1.0, SPARE * max_rows / max(1, r["rows"]))) for r in sizes.collect()],  # a row per kind
                                   sizes.select("kind", F.lit(1.0).alias("share")).schema)
    place = F.pmod("key1", F.lit(1 << 20)) / (1 << 20)
    near = narrow.join(F.broadcast(ranges), "kind").where(place < F.col("share")).groupBy("kind", "key1", "key2").agg(F.max("n").alias("n"))
    order = Window.partitionBy("kind").orderBy("key1", "key2")
    chosen = near.withColumn("at", F.row_number().over(order)).where(F.col("at") <= max_rows)
    chosen = chosen.withColumn("upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("upto") <= max_chars)
    on = ["key1", "key2"] + (["kind"] if kinds is None else [])
    return keyed.join(F.broadcast(chosen.select("kind", "key1", "key2")), on).groupBy("kind", "key1", "key2").agg(
        F.any_value("id").alias("id"), F.any_value("text").alias("text")).select("kind", "id", "text")
