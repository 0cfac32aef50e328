"""Substring deduplication by super-k-mer partitioning (operator 3).

A window is 20 consecutive words of a document. Its minimiser is the smallest of
its 3-word hashes; consecutive windows with one minimiser travel as one packed
string (a super-k-mer) to the minimiser's bucket, where sorting brings equal
windows together. Every window with an equal one earlier (smaller doc_id, or
same document, earlier start) covers its words, and covered words go.

Scale: tasks drop windows that repeat inside their own few MB first, so a
passage in very many documents reaches its bucket once per few MB. A sketch of
all 3-word counts (2^16 counters, whatever the corpus) makes frequent 3-word
sequences the last choice as minimisers: windows that hold anything rarer go by
that, so boilerplate does not gather its surroundings in one bucket.

Exactness: equal 64-bit window hashes are confirmed on the words. A row is known
by its doc_id; where ids repeat (nulls count as one id), by two more independent
64-bit hashes of its text.

Defined results: a null or empty text has no words; a text of under 20 words
keeps them all; a very long text is cut into a slice of its own and whole;
rows with equal doc_id and text get equal results, neither being
earlier than the other; a null doc_id comes before all others; an empty table
gives an empty table; other columns are not looked at.
"""

from __future__ import annotations

import struct
from itertools import compress as pick

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import (
    NULL_ID, SLOTS, Words, as_bytes, doc_text, frequent_slots, rolling, scramble, sliding_min, small_batches, text_slices)

WINDOW, MINIMISER = 20, 3
#: Windows that a bucket should hold.
BUCKET_WINDOWS = 400_000
SLICE_BYTES = 8 << 20


def _mmers(words: Words, m: int) -> np.ndarray:
    return scramble(rolling(words.quick, m))


def _repeats(words: Words, at: np.ndarray, hashes: np.ndarray, doc: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """Of windows in (doc, start) order, which have an equal one with a smaller (doc, start).

    at: word positions of the windows; hashes, doc, start: of each window.
    """
    out = np.zeros(len(at), bool)
    order = np.argsort(hashes, kind="stable")
    key = hashes[order]
    same = np.flatnonzero(key[1:] == key[:-1])
    if not len(same):
        return out
    left, right = at[order[same]], at[order[same + 1]]
    line, place = words.line, words.place
    spans = zip(*(x.tolist() for x in (place[left], place[left + n], place[right], place[right + n])))
    equal = np.fromiter((line[a:b] == line[c:d] for a, b, c, d in spans), bool, len(same))
    first = np.arange(len(order))
    first[same + 1] = 0
    first = np.maximum.accumulate(first)  # where each run of equal hashes begins
    mine, lead = order[same + 1], order[first[same + 1]]
    out[mine] = (doc[lead] < doc[mine]) | ((doc[lead] == doc[mine]) & (start[lead] < start[mine]))
    if not equal.all():  # two window texts share a 64-bit hash: tell them apart by their words
        for run in np.unique(first[same[~equal] + 1]).tolist():
            seen: dict[bytes, int] = {}
            end = run
            while end < len(key) and key[end] == key[run]:
                w = int(order[end])
                lead1 = seen.setdefault(line[place[at[w]]:place[at[w] + n]], w)
                out[w] = (doc[lead1], start[lead1]) < (doc[w], start[w])
                end += 1
    return out


def _runs(flag: np.ndarray, at: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of the runs of flagged windows at consecutive positions that agree in keys."""
    idx = np.flatnonzero(flag)
    if not len(idx):
        return idx, idx
    cut = (np.diff(idx) != 1) | (np.diff(at[idx]) != 1)
    for k in keys:
        cut |= k[idx[1:]] != k[idx[:-1]]
    where = np.flatnonzero(cut)
    return idx[np.concatenate([[0], where + 1])], idx[np.concatenate([where, [len(idx) - 1]])]


def _pack(parts: list[tuple[np.ndarray, ...]], text: bytes) -> bytes:
    """Two tables of integer columns and the packed strings, compressed."""
    raw = [struct.pack("<II", *(len(p[0]) for p in parts))]
    raw += [np.ascontiguousarray(c, "<i8").tobytes() for p in parts for c in p]
    return zstandard.ZstdCompressor(level=7).compress(b"".join(raw) + text)


def _unpack(blob: bytes) -> tuple[list[np.ndarray], list[np.ndarray], bytes]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    a, b = struct.unpack_from("<II", raw)
    at, cols = 8, []
    for n in [a] * 4 + [b] * 5:
        cols.append(np.frombuffer(raw, "<i8", n, at))
        at += 8 * n
    return cols[:4], cols[4:], raw[at:]


#: Seeds of the two text hashes; the second is Spark's hash of the integer 1.
SEED = 42
SEED2 = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), SEED)


def text_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each text, equal to those of `key_columns`."""
    return tuple(np.array([xxhash.xxh64_intdigest(t, seed) for t in texts], np.uint64).astype(np.int64) for seed in (SEED, SEED2))


def key_columns(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def _delta(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x[:1] * 0)


def super_kmers(docs: DataFrame, frequent: np.ndarray, n_buckets: int, window: int, m: int, hashed: bool = True) -> DataFrame:
    """(bucket, blob): the super-k-mers of each bucket from a few MB of text, and windows already known to repeat.

    Without `hashed` (no id repeats), rows are known by their ids alone.
    """
    def cut(batches):
        for turn, b in enumerate(text_slices(batches, "text", SLICE_BYTES)):
            ids = b.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            by_id = np.argsort(ids, kind="stable")
            ids, raw = ids[by_id], as_bytes(b.column("text"))
            texts = [raw[i] for i in by_id.tolist()]
            words = Words(texts)
            at = words.window_starts(window)
            if not len(at):
                continue
            key1, key2 = text_keys(texts) if hashed else (np.zeros(len(texts), np.int64),) * 2
            which = words.doc_of()[at]
            doc, start = ids[which], at - words.starts[which]
            gone = _repeats(words, at, rolling(words.quick, window)[at], doc, start, window)
            h = _mmers(words, m)
            h = (h >> np.uint64(1)) | (frequent[(h & np.uint64(SLOTS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(63))
            least = sliding_min(h, window - m + 1)[at]
            lo, hi = _runs(~gone, at, which, least)
            bucket = (least[lo] % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            lo, hi, bucket = lo[order], hi[order], bucket[order]
            line = words.line
            begin, end = words.place[at[lo]].tolist(), (words.place[at[hi] + window] - 1).tolist()
            strings = [line[x:y] for x, y in zip(begin, end)]
            known_lo, known_hi = _runs(gone, at, which)
            of = which[known_lo]
            known = (ids[of], key1[of], key2[of], start[known_lo], start[known_hi] + window)
            none = tuple(x[:0] for x in known)
            cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(bucket)] if len(bucket) else []
            spare = [] if cuts else [turn % n_buckets]
            out_bucket, blobs = [], []
            for x, y in zip(cuts, cuts[1:]):
                d = which[lo[x:y]]
                o = np.lexsort((start[lo[x:y]], d))  # small steps between neighbours compress well
                part = (_delta(ids[d[o]]), key1[d[o]], key2[d[o]], start[lo[x:y]][o])
                text = b"\n".join([strings[i] for i in (x + o).tolist()])
                out_bucket.append(int(bucket[x]))
                blobs.append(_pack([part, known if x == 0 else none], text))
            for x in spare:
                out_bucket.append(x)
                blobs.append(_pack([none[:4], known], b""))
            yield pa.RecordBatch.from_arrays([pa.array(out_bucket, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    return docs.mapInArrow(cut, "bucket int, blob binary")


_COVER = pa.schema([(c, pa.int64()) for c in ("doc", "key1", "key2", "lo", "hi")])


def repeated_spans(packed: DataFrame, window: int) -> DataFrame:
    """Word spans (doc, key1, key2, lo, hi) that a window with an earlier equal covers, bucket by bucket."""
    def judge(group: pa.Table) -> pa.Table:
        cols, known, texts = [], [], []
        for blob in group.column("blob").to_pylist():
            part, old, text = _unpack(blob)
            known.append(old)
            if len(part[0]):
                cols.append((np.cumsum(part[0]), *part[1:]))
                texts += text.split(b"\n")
        out = [np.concatenate(x) for x in zip(*known)]
        if texts:
            doc, key1, key2, start = (np.concatenate(x) for x in zip(*cols))
            order = np.lexsort((start, doc))
            doc, key1, key2, start = doc[order], key1[order], key2[order], start[order]
            words = Words([texts[i] for i in order.tolist()])
            del texts
            at = words.window_starts(window)
            which = words.doc_of()[at]
            begin = start[which] + at - words.starts[which]
            by_place = np.lexsort((begin, doc[which]))
            at, which, begin = at[by_place], which[by_place], begin[by_place]
            gone = _repeats(words, at, rolling(words.quick, window)[at], doc[which], begin, window)
            lo, hi = _runs(gone, at, which)
            of = which[lo]
            out = [np.concatenate([x, y]) for x, y in zip(out, (doc[of], key1[of], key2[of], begin[lo], begin[hi] + window))]
        return pa.table(dict(zip(_COVER.names, out)), schema=_COVER)

    return packed.groupBy("bucket").applyInArrow(judge, "doc long, key1 long, key2 long, lo long, hi long")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                     m: int = MINIMISER, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the words left, joined by one space)."""
    small_batches(docs.sparkSession)
    docs = doc_text(docs, id_col, text_col)
    frequent, total = frequent_slots(docs, m)
    hashed = not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    packed = super_kmers(docs, frequent, total // bucket_windows + 1, window, m, hashed)
    keys = ["doc", "key1", "key2"]
    spans = repeated_spans(packed, window).groupBy(*keys).agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    one, two = key_columns(F.coalesce("text", F.lit(""))) if hashed else (F.lit(0).cast("long"),) * 2
    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), one.alias("key1"), two.alias("key2"))
    joined = keyed.join(spans, keys, "left").select("doc_id", "text", "spans")

    def strip(batches):
        for b in text_slices(batches, "text"):
            n, gone, kept = [], [], []
            spans_of = b.column("spans")
            flat, ends = spans_of.flatten(), np.cumsum(pa.compute.list_value_length(spans_of).fill_null(0).to_numpy(zero_copy_only=False))
            lo_all, hi_all = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
            begin = 0
            for text, end in zip(as_bytes(b.column("text")), ends.tolist()):
                words = text.split()
                n.append(len(words))
                if end > begin:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, lo_all[begin:end], 1)
                    np.add.at(edge, hi_all[begin:end], -1)
                    keep = np.cumsum(edge[:-1]) == 0
                    words = list(pick(words, keep.tolist()))
                    begin = end
                gone.append(n[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(strip, "doc_id long, n_words long, n_removed long, kept string")


def digest(kept: DataFrame) -> DataFrame:
    """The result with a SHA-256 in place of the kept words."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))

