"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman (operator 2).

Words are lower-cased, without punctuation at their ends. Word counts over the
whole corpus tell how likely each 3-word sequence of a benchmark item is by
chance; the rare ones are its seeds. Every position of every document is looked
up among the seeds; hits on neighbouring diagonals open one region of the text,
and a local word alignment of the item against it scores exact, edited and
partial copies. A pair counts from `least` of the item's perfect score.

The benchmark is the stated query side: it is read in blocks of up to
`block_words` words, each broadcast and run against all documents. Items with
equal words, anywhere in the benchmark, are one: the least item_id stands for
them and `n_items` counts them.

Defined results: a null or empty text or item matches nothing; an item of under
3 words is its own seed; an item without an id gives no row, but the filter
drops documents that hold it; very long texts are searched whole; equal scores go
to the first place in the text; repeated rows give equal rows; empty tables give an
empty table; other columns are not looked at, and pass through the filter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import NULL_ID, U64, Words, as_bytes, doc_text, rolling, scramble, small_batches, text_slices
from gridcast.session import materialize

SEED = 3
#: Chance of a seed at a text position, at most; items without SEEDS such ones take their rarest.
RARE, SEEDS = 1e-7, 4
MATCH, MISMATCH, GAP = 2, -1, -1
LEAST = 0.45
#: Words of the benchmark in one block; cells of the alignment table filled at once.
BLOCK_WORDS, CELLS = 2_000_000, 1 << 21
_EDGE = b".,;:!?\"'()[]{}<>*#$%&|-_/\\"
_FILTER_BITS = 20


def normal(word: bytes) -> bytes:
    return (word.lower() if word.isascii() else word.decode().lower().encode()).strip(_EDGE)


class Text:
    """The normalised words of several texts, end to end: 64-bit hashes and the first word of each text."""

    def __init__(self, texts: list[bytes]):
        words = Words(texts)
        names = [normal(w) for w in words.vocab]
        own = np.fromiter((xxhash.xxh64_intdigest(w) if w else 0 for w in names), U64, len(names))
        hashes = own[words.ids] if len(words) else np.zeros(0, U64)
        keep = np.array([bool(w) for w in names], bool)[words.ids] if len(words) else np.zeros(0, bool)
        self.hashes = hashes[keep]
        self.starts = np.concatenate([[0], np.cumsum(keep)])[words.starts]

    def seeds(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions where n words of one text begin, and the hash of those words."""
        ends = np.repeat(self.starts[1:], np.diff(self.starts))
        at = np.flatnonzero(np.arange(len(self.hashes)) + n <= ends)
        return at, scramble(rolling(self.hashes, n)[at] + U64(n))


class Items:
    """A block of benchmark items with their seeds, sorted by hash."""

    def __init__(self, ids: list, texts: list[bytes], n_items: list[int]):
        text = Text(texts)
        words = [text.hashes[x:y] for x, y in zip(text.starts[:-1].tolist(), text.starts[1:].tolist())]
        held = [i for i, w in enumerate(words) if len(w)]
        self.words, self.ids, self.n_items = [words[i] for i in held], [ids[i] for i in held], [n_items[i] for i in held]
        self.vocab = np.unique(np.concatenate(self.words)) if self.words else np.zeros(0, U64)

    def choose(self, counts: np.ndarray, total: int) -> None:
        """Pick the seeds, given how often each word of vocab occurs in the corpus and the corpus' words."""
        log_p = np.log((counts + 1) / (total + len(counts) + 1))
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.sizes = set()
        for i, w in enumerate(self.words):
            n = min(SEED, len(w))
            self.sizes.add(n)
            each = log_p[np.searchsorted(self.vocab, w)]
            chance = sum(each[j:len(w) - n + 1 + j] for j in range(n))
            order = np.argsort(chance, kind="stable")
            rare = order[:max(SEEDS, int((chance <= np.log(RARE)).sum()))]
            found.append((scramble(rolling(w, n)[rare] + U64(n)), np.full(len(rare), i), rare))
        self.seed, self.item, self.at = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, U64), np.zeros(0, int), np.zeros(0, int))
        order = np.argsort(self.seed, kind="stable")
        self.seed, self.item, self.at = self.seed[order], self.item[order], self.at[order]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(self.seed >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def hits(self, text: Text) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text position, item, position in item) of every seed found."""
        out = []
        for n in sorted(self.sizes):
            at, h = text.seeds(n)
            maybe = self.filter[(h >> U64(64 - _FILTER_BITS)).astype(np.int64)]
            at, h = at[maybe], h[maybe]
            lo, hi = np.searchsorted(self.seed, h, "left"), np.searchsorted(self.seed, h, "right")
            size = hi - lo
            where = np.arange(int(size.sum())) + np.repeat(lo - (np.cumsum(size) - size), size)
            out.append((np.repeat(at, size), self.item[where], self.at[where]))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def align(items: list[np.ndarray], regions: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman over words with linear gaps: best score of each pair, and where in the region it ends.

    Pairs of similar length are padded to one block and filled row by row; the
    gap along a row is a running maximum, so no row needs a loop over its cells.
    """
    best, end = np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    order = sorted(range(len(items)), key=lambda i: (len(items[i]), len(regions[i])))
    lo = 0
    while lo < len(order):
        hi, wide = lo, 1
        while hi < len(order) and (hi == lo or max(wide, len(regions[order[hi]])) * (hi - lo + 1) <= CELLS // 8):
            wide = max(wide, len(regions[order[hi]]))
            hi += 1
        part = order[lo:hi]
        tall = max(len(items[i]) for i in part)
        a, b = np.zeros((len(part), tall), U64), np.ones((len(part), wide), U64)  # 0 and 1: never equal to each other
        for k, i in enumerate(part):
            a[k, :len(items[i])] = items[i]
            b[k, :len(regions[i])] = regions[i]
        slope = -GAP * np.arange(wide)
        row = np.zeros((len(part), wide + 1), np.int64)
        top, where = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        for j in range(tall):
            step = np.where(a[:, j:j + 1] == b, MATCH, MISMATCH)
            new = np.maximum(np.maximum(row[:, :-1] + step, row[:, 1:] + GAP), 0)
            new = np.maximum.accumulate(new + slope, axis=1) - slope
            row[:, 1:] = new
            at = new.argmax(1)
            value = new[np.arange(len(part)), at]
            better = value > top
            top[better], where[better] = value[better], at[better] + 1
        best[part], end[part] = top, where
        lo = hi
    return best, end


def matches(texts: list[bytes], items: Items, least: float) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score, end word, regions) of every pair that reaches `least` of the item's perfect score."""
    text = Text(texts)
    at, item, inner = items.hits(text)
    if not len(at):
        return []
    doc = np.searchsorted(text.starts, at, "right") - 1
    diagonal = at - inner - text.starts[doc]
    order = np.lexsort((diagonal, item, doc))
    doc, item, diagonal = doc[order], item[order], diagonal[order]
    length = np.array([len(w) for w in items.words])[item]
    slack = length // 3 + 4
    new = np.concatenate([[True], (np.diff(doc) != 0) | (np.diff(item) != 0) | (np.diff(diagonal) > slack[1:])])
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1
    begin = text.starts[doc[first]]
    stop = text.starts[doc[first] + 1]
    lo = np.maximum(begin, begin + diagonal[first] - slack[first])
    hi = np.minimum(stop, begin + diagonal[last] + length[first] + slack[first])
    found: dict[tuple[int, int], list] = {}
    for x in range(0, len(first), 4096):
        part = range(x, min(x + 4096, len(first)))
        best, end = align([items.words[item[first[k]]] for k in part], [text.hashes[lo[k]:hi[k]] for k in part])
        for k, score, e in zip(part, best.tolist(), end.tolist()):
            share = score / (MATCH * int(length[first[k]]))
            if share >= least:
                got = found.setdefault((int(doc[first[k]]), int(item[first[k]])), [0.0, 0, 0])
                got[2] += 1
                if share > got[0]:
                    got[0], got[1] = share, int(lo[k] - begin[k] + e)
    return [(d, i, *v) for (d, i), v in sorted(found.items())]


def distinct_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, n): items with equal normalised words as one, under their least id, over the whole benchmark."""
    def keys(batches):
        for b in text_slices(batches, "text"):
            text = Text(as_bytes(b.column("text")))
            words = [text.hashes[x:y] for x, y in zip(text.starts[:-1].tolist(), text.starts[1:].tolist())]
            rows = pa.RecordBatch.from_arrays([b.column("id"), b.column("text"), pa.array(
                [hashlib.blake2b(w.tobytes(), digest_size=16).digest() if len(w) else None for w in words], pa.binary())], names=["id", "text", "words"])
            yield rows.filter(pa.compute.is_valid(rows.column("words")))

    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where(
        F.col("id").isNotNull() & F.col("text").isNotNull())
    return rows.mapInArrow(keys, "id long, text string, words binary").groupBy("words").agg(
        F.min("id").alias("id"), F.min_by("text", "id").alias("text"), F.count(F.lit(1)).alias("n")).drop("words")


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int):
    """The distinct items, by id, in blocks of bounded size, a few rows at a time on the driver."""
    ids, texts, counts, size = [], [], [], 0
    for r in materialize(distinct_items(benchmark, id_col, text_col), "benchmark-items").orderBy("id", "text").toLocalIterator():
        ids.append(r["id"])
        texts.append(r["text"].encode())
        counts.append(r["n"])
        size += len(texts[-1].split())
        if size >= block_words:
            yield Items(ids, texts, counts)
            ids, texts, counts, size = [], [], [], 0
    if ids:
        yield Items(ids, texts, counts)


def _with_seeds(docs: DataFrame, items: Items) -> Items:
    """Choose the seeds of a block by its words' counts over all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(items.vocab)

    def count(batches):
        vocab = shared.value
        total, n = np.zeros(len(vocab), np.int64), 0
        for b in text_slices(batches, "text"):
            h = Text(as_bytes(b.column("text"))).hashes
            at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
            total += np.bincount(at[vocab[at] == h], minlength=len(vocab))
            n += len(h)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(total[used], n))], names=["word", "n"])

    counts, total = np.zeros(len(items.vocab), np.int64), 0
    for r in docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect():
        if r["word"] < 0:
            total = r["n"]
        else:  # a row per word of the block
            counts[r["word"]] = r["n"]
    items.choose(counts, total)
    return items


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and benchmark item in it: doc_id, item_id, score, end_word, n_regions, n_items."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = doc_text(docs, id_col, text_col)
    schema = "doc_id long, item_id long, score double, end_word long, n_regions long, n_items long"
    out = spark.createDataFrame([], schema)
    for items in _blocks(benchmark, item_col, item_text_col, block_words):
        shared = spark.sparkContext.broadcast(_with_seeds(docs, items))

        def find(batches, shared=shared):
            block = shared.value
            for b in text_slices(batches, "text"):
                got = matches(as_bytes(b.column("text")), block, least)
                ids = b.column("doc_id").to_pylist()
                yield pa.RecordBatch.from_pylist([
                    {"doc_id": ids[d], "item_id": block.ids[i], "score": s, "end_word": e, "n_regions": n, "n_items": block.n_items[i]}
                    for d, i, s, e, n in got], schema=_PAIR)

        out = out.union(docs.mapInArrow(find, schema))
    return out


_PAIR = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()), ("end_word", pa.int64()),
                   ("n_regions", pa.int64()), ("n_items", pa.int64())])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text", least: float = LEAST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns. Texts stay where they are: no shuffle."""
    small_batches(docs.sparkSession)
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    where = [c.lower() for c in docs.columns].index(text_col.lower())
    name = docs.columns[where]
    texts = docs.select(F.col(text_col).alias("text"))
    benchmark = benchmark.withColumn(item_col, F.coalesce(F.col(item_col).cast("long"), F.lit(NULL_ID)))  # only texts count here
    out = docs
    for items in _blocks(benchmark, item_col, item_text_col, block_words):
        shared = docs.sparkSession.sparkContext.broadcast(_with_seeds(texts, items))

        def clean(batches, shared=shared):
            for b in text_slices(batches, name):
                bad = {m[0] for m in matches(as_bytes(b.column(where)), shared.value, least)}
                yield b.filter(pa.array([i not in bad for i in range(b.num_rows)], pa.bool_()))

        out = out.mapInArrow(clean, docs.schema)
    return out
