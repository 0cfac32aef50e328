"""N-gram Jaccard join by T-occurrence search (operator 7).

A document's set holds its distinct 5-word shingles (A-Z lower-cased); two
documents link when 100 * |intersection| >= 80 * |union|.

1. Documents with equal sets are one node (a 64-bit digest, checked by another).
2. Linked sets share 4 of their first |s| - ceil(0.8 |s|) + 4 shingles in a
   common order: rarer before more frequent ones, as a sketch of all shingle
   counts tells them, then by hash. The sketch has 2^26 slots that no task holds
   at once, so that it tells a passage of some hundred documents from chance in a
   large corpus too. Of the nodes that have a shingle in their prefix, those stay whose size and position of it allow a link to another one; the
   least is the shingle's *anchor*. Nodes with one anchor form a block. Pairs that
   share short lists only must share 4, which drops chance meetings; so any two
   linked nodes still meet in a block.
3. A bitmap of each set bounds what two sets can share; sets that cannot link to
   any other one of their block, or of its part, leave before texts are sent.
   In a block, DivideSkip finds the nodes that share at least T shingles with a
   query: its long inverted lists are left out, the short ones merged, and what
   occurs T - L times there is probed in the L long lists. Pairs that links
   connect already are not compared, and queries stop once all nodes that have
   not been one are connected: a block of n near copies takes few searches.
4. Blocks above `block_shingles` are cut. Each part holds the anchor; nodes that
   are not connected to it there meet all parts in a second search.

Defined results: a null or empty text, or one without words, has an empty set
and its own doc_id as component; under 5 words, the whole sequence is one
shingle; repeated rows link; a null doc_id takes part, and a component's id is
its least doc_id that is not null; an empty table gives an empty table; other
columns are not looked at.
"""

from __future__ import annotations

from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gridcast.llm.common import (
    NULL_ID, U64, WORD_RE, Words, as_bytes, doc_text, free_name, rolling, scramble, small_batches, text_slices)
from gridcast.llm.components import components
from gridcast.session import materialize

SHINGLE, PERCENT = 5, 80
#: Slots of the sketch of shingle counts, the ranges of them that tasks add up, and shingles packed at once.
SLOTS, RANGES, PACKED = 1 << 26, 1 << 10, 1 << 22
#: A shingle is rare below this count and twice the sketch's mean. A range names its KEPT fullest frequent slots at most.
RARE, KEPT = 64, 1 << 10
#: Frequency levels are half powers of two (0 is rare); from HOT on, 1/2^15 of all shingles, a shingle is hot.
HOT, HOT_SHARE = 40, 1 << 15
BLOCK_SHINGLES = 400_000
#: Slots of the bitmap that spares documents outside all blocks the join with their texts.
NEEDED_SLOTS = 1 << 20
#: Ratio of the size bands in the filter of inverted lists; lists up to this length are filtered pair by pair.
BAND, LIST = 1.02, 256
#: Linked sets share at least COMMON of their first |s| - need + COMMON shingles (4 of any 5, so 4 at most).
#: Lists of up to SHORT nodes are taken pair by pair.
COMMON, SHORT = 4, 8
_LIST, _PAIR, _FREQUENT = 0, 1, 2
#: Words of bitmaps compared at once; blocks of more sets than MANY are not compared by bitmaps.
PAIR_WORDS, MANY = 1 << 20, 4096
#: Weight of DivideSkip's rule for the number of long lists, T / (MU log2(longest) + 1).
MU = 0.0085


# ---- sets ---------------------------------------------------------------------

def shingle_sets(texts: list[bytes], n: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    texts = [t.lower() for t in texts]  # bytes: A-Z alone
    words = Words(texts)
    at = words.window_starts(n)
    which = words.doc_of()[at]
    h = scramble(rolling(words.hashes, n)[at])
    order = np.lexsort((h, which))
    h, which = h[order], which[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (which[1:] != which[:-1])
    h, which = h[new], which[new]
    cut = np.searchsorted(which, np.arange(len(texts) + 1))
    out = []
    for i in range(len(texts)):
        size = words.starts[i + 1] - words.starts[i]
        if 0 < size < n:
            out.append(np.array([xxhash.xxh64_intdigest(b" ".join(words.flat[words.starts[i]:words.starts[i + 1]]), 1)], U64))
        else:
            out.append(h[cut[i]:cut[i + 1]])
    return out


def least_overlap(size: int, percent: int = PERCENT) -> int:
    """Shingles that a set of this size must share with any set it links to."""
    return -(-percent * size // 100)


def _node(s: np.ndarray) -> tuple[int, int]:
    raw = s.tobytes()
    return (xxhash.xxh64_intdigest(raw) ^ (1 << 63)) - (1 << 63), (xxhash.xxh64_intdigest(raw, 7) ^ (1 << 63)) - (1 << 63)


def _pairs_needed(a, b, percent: int):
    """Intersection that sets of sizes a and b need: percent * union / 100 with union = a + b - intersection."""
    return -(-percent * (a + b) // (100 + percent))


# ---- bitmaps ------------------------------------------------------------------

def bitmap(s: np.ndarray) -> bytes:
    """A bit per hash of the set, in the least power of two from 5/4 bits a shingle on (64 at least)."""
    width = 1 << max(6, (5 * len(s) // 4).bit_length())
    bits = np.zeros(width, bool)
    bits[((s >> U64(20)) & U64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_link(size: np.ndarray, bits: list[bytes], settled: np.ndarray | None = None, percent: int = PERCENT) -> np.ndarray:
    """Which sets may link to another of these. A bit that one set has and the other lacks is a shingle not shared.

    Pairs of two settled sets do not count.
    Bitmaps of twice the width are folded; linked sets differ in size by less,
    so only equal and neighbouring widths are compared. Never drops a link.
    """
    out = np.zeros(len(size), bool)
    width = np.array([len(b) for b in bits])
    rows = {w: np.flatnonzero(width == w) for w in np.unique(width).tolist()}
    table = {w: np.frombuffer(b"".join(bits[i] for i in at.tolist()), np.uint64).reshape(len(at), -1) for w, at in rows.items()}

    def compare(one, a, other, b):
        step = max(1, PAIR_WORDS // max(1, b.size))
        for lo in range(0, len(one), step):
            i = one[lo:lo + step]
            x = a[lo:lo + step, None, :]
            mine = size[i][:, None] - np.bitwise_count(x & ~b[None]).sum(2, dtype=np.int64)
            others = size[other][None, :] - np.bitwise_count(b[None] & ~x).sum(2, dtype=np.int64)
            ok = np.minimum(mine, others) >= _pairs_needed(size[i][:, None], size[other][None, :], percent)
            ok &= i[:, None] != other[None, :]
            if settled is not None:
                ok &= ~(settled[i][:, None] & settled[other][None, :])
            out[i] |= ok.any(1)
            out[other] |= ok.any(0)

    for w, at in rows.items():
        compare(at, table[w], at, table[w])
        if 2 * w in rows:
            half = table[2 * w].shape[1] // 2
            compare(at, table[w], rows[2 * w], table[2 * w][:, :half] | table[2 * w][:, half:])
    return out


# ---- search -------------------------------------------------------------------

class _Union:
    def __init__(self, n: int):
        self.up, self.size = list(range(n)), [1] * n

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        if self.size[x] < self.size[y]:
            x, y = y, x
        self.up[y] = x
        self.size[x] += self.size[y]
        return True


class Index:
    """Inverted lists of a few thousand sets, as one sorted array of token * n + set.

    Lists of n/64 sets or more, which together take no more bits than the array,
    are also columns of a bit matrix with a row per set, the longest first.
    """

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.percent, self.n = percent, len(sets)
        self.size = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(self.n), self.size)
        _, token, df = np.unique(np.concatenate(sets) if sets else np.zeros(0, U64), return_inverse=True, return_counts=True)
        shared = df[token] > 1
        need = -(-percent * self.size // 100)
        #: sets with too few shared tokens to link to any other
        self.live = np.bincount(owner[shared], minlength=self.n) >= np.maximum(need, 1)
        keep = shared & self.live[owner]
        owner, token = owner[keep], token[keep]
        self.of = np.split(token, np.searchsorted(owner, np.arange(1, self.n))) if self.n else []
        self.posting = np.sort(token * self.n + owner, kind="stable")
        self.begin = np.searchsorted(self.posting, np.arange(len(df) + 1) * self.n)
        self.member = self.posting % max(1, self.n)
        length = np.diff(self.begin)
        wide = np.flatnonzero((length > 1) & (64 * length >= self.n))
        self.column = np.full(len(df), -1)
        self.column[wide[np.argsort(-length[wide], kind="stable")]] = np.arange(len(wide))
        self.bits = np.zeros((self.n, -(-len(wide) // 64)), U64)
        at = self.column[token]
        owner, at = owner[at >= 0], at[at >= 0]
        np.bitwise_or.at(self.bits, (owner, at >> 6), U64(1) << (at & 63).astype(U64))

    def search(self, q: int, skip) -> list[int]:
        """Sets that link to set q, by DivideSkip; skip(r) tells those that need no comparison."""
        token = self.of[q]
        need = int(-(-self.percent * self.size[q] // 100))
        length = self.begin[token + 1] - self.begin[token]
        order = np.argsort(length, kind="stable")
        token, length = token[order], length[order]
        if len(token) < need:
            return []
        n_long = min(need - 1, int(need / (MU * np.log2(max(2, int(length[-1]))) + 1)))
        short, longer = token[:len(token) - n_long], token[len(token) - n_long:]
        part = length[:len(short)]
        total = int(part.sum())
        where = np.arange(total) + np.repeat(self.begin[short] - (np.cumsum(part) - part), part)
        if 8 * total < self.n:
            found, count = np.unique(self.member[where], return_counts=True)  # merges the short lists
        else:
            count = np.bincount(self.member[where], minlength=self.n)
            found = np.flatnonzero(count)
            count = count[found]
        big, small = np.maximum(self.size[found], self.size[q]), np.minimum(self.size[found], self.size[q])
        good = (count >= need - n_long) & (found != q) & (100 * small >= self.percent * big)
        found, count = found[good], count[good]
        if not len(found):
            return []
        # long lists that are columns are probed all at once, the others by binary search
        at = self.column[longer]
        longer, at = longer[at < 0], at[at >= 0]
        mask = np.zeros(self.bits.shape[1], U64)
        np.bitwise_or.at(mask, at >> 6, U64(1) << (at & 63).astype(U64))
        used = np.flatnonzero(mask)
        count = count + np.bitwise_count(self.bits[found[:, None], used] & mask[used]).sum(1, dtype=np.int64)
        want = _pairs_needed(self.size[found], self.size[q], self.percent)
        good = count + len(longer) >= want
        good[good] = [not skip(r) for r in found[good].tolist()]
        found, count, want = found[good], count[good], want[good]
        if len(longer) and len(found):
            probe = longer[None, :] * self.n + found[:, None]
            at = np.minimum(np.searchsorted(self.posting, probe), len(self.posting) - 1)
            count = count + (self.posting[at] == probe).sum(1)
        return found[count >= want].tolist()


def block_links(sets: list[np.ndarray], joined: list[int], percent: int = PERCENT) -> tuple[list[tuple[int, int]], _Union]:
    """Links that connect the sets of a block as all their links do. joined: sets already known to be connected."""
    index, known = Index(sets, percent), _Union(len(sets))
    for x in joined[1:]:
        known.join(joined[0], x)
    links, waiting = [], [i for i in range(len(sets)) if index.live[i]]
    while waiting:
        sizes: dict[int, int] = {}
        for x in waiting:
            sizes[known.find(x)] = sizes.get(known.find(x), 0) + 1
        if len(sizes) == 1:
            break
        largest = max(sizes, key=sizes.get)
        # those outside the largest component, until another one outgrows it
        left = []
        for i, q in enumerate(waiting):
            root = known.find(q)
            if root == known.find(largest):
                left.append(q)
                continue
            before = len(links)
            for r in index.search(q, lambda r: known.find(r) == known.find(q)):
                if known.join(q, r):
                    links.append((q, r))
            if len(links) - before > len(left) + 8:
                left += waiting[i + 1:]
                break
        waiting = left
    return links, known


# ---- tables -------------------------------------------------------------------

def _packed(slots: np.ndarray) -> tuple[list[int], list[bytes]]:
    """Sorted uint32 slots by range, as compressed gaps: a byte 255 passes so many slots, a lower one names the slot it leads to."""
    width = SLOTS // RANGES
    cut = np.searchsorted(slots, np.arange(RANGES + 1, dtype=np.uint32) * np.uint32(width))
    used = np.flatnonzero(np.diff(cut)).tolist()
    squeeze, blobs = zstandard.ZstdCompressor(level=1), []
    for r in used:
        gap = np.diff(slots[cut[r]:cut[r + 1]], prepend=np.uint32(r * width))
        skip = (gap // 255).astype(np.int64)
        line = np.full(len(gap) + int(skip.sum()), 255, np.uint8)
        line[np.cumsum(skip + 1) - 1] = gap % 255
        blobs.append(squeeze.compress(line.tobytes()))
    return used, blobs


def _unpacked(blob: bytes) -> np.ndarray:
    """Places in its range of the slots in a blob of _packed."""
    line = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.cumsum(line, dtype=np.int64)[line < 255]


def _sized(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Set sizes and digests, and the frequency levels of shingle hashes, from one pass.

    The table is (doc_id, mark, n, node, proof, bits); mark tells rows of one doc_id
    apart by their texts, bits is the set's bitmap.
    """
    def counted(slots: list[np.ndarray]) -> pa.RecordBatch:
        used, blobs = _packed(np.sort(np.concatenate(slots)))
        none = pa.nulls(len(used), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, none, none, pa.array(blobs, pa.binary()), pa.array(used, pa.int32())], names=names)

    def digest(batches):
        slots, held = [np.zeros(0, np.uint32)], 0
        for b in text_slices(batches, "text"):
            sets = shingle_sets(as_bytes(b.column("text")))
            keys = [_node(s) for s in sets]
            slots.append((np.concatenate(sets) & U64(SLOTS - 1)).astype(np.uint32))
            held += len(slots[-1])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("mark"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                 pa.array([bitmap(s) for s in sets], pa.binary()), pa.nulls(len(sets), pa.int32())], names=names)
            if held >= PACKED:
                yield counted(slots)
                slots, held = slots[:1], 0
        yield counted(slots)

    names = ["doc_id", "mark", "n", "node", "proof", "bits", "slot"]
    rows = docs.withColumn("mark", F.xxhash64("text")).mapInArrow(
        digest, "doc_id long, mark long, n long, node long, proof long, bits binary, slot int")
    rows = materialize(rows, "jaccard-sizes")
    sized = rows.where("slot is null").drop("slot")
    total = sized.agg(F.sum("n")).first()[0] or 0
    return sized, _levels(rows.where("slot is not null").select("slot", "bits"), total)


def _levels(ranges: DataFrame, total: int) -> np.ndarray:
    """The frequency level of a shingle by the low bits of its hash, from packed slots (slot: their range, bits). total: all shingles.

    Levels count in how many documents a slot's shingles stand. The table is as
    small as the frequent slots allow; a rare shingle that meets one of them in it
    comes late in the order, which no result depends on.
    """
    width, least = SLOTS // RANGES, RARE + 2 * total // SLOTS

    def add(batches):
        at, full = None, None

        def frequent() -> pa.RecordBatch:
            place = np.flatnonzero(full >= least)
            place = place[np.argsort(-full[place], kind="stable")[:KEPT]]
            return pa.RecordBatch.from_arrays([pa.array((at * width + place).astype(np.int32)), pa.array(full[place])], names=["slot", "n"])

        for b in batches:
            for r, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if r != at:
                    if at is not None:
                        yield frequent()
                    at, full = r, np.zeros(width, np.int64)
                np.add.at(full, _unpacked(blob), 1)
        if at is not None:
            yield frequent()

    found = ranges.repartition("slot").sortWithinPartitions("slot").mapInArrow(add, "slot int, n long").toArrow()  # KEPT rows a range at most
    slot, n = found.column(0).to_numpy(), found.column(1).to_numpy()
    levels = np.zeros(1 << max(18, (16 * len(slot)).bit_length()), np.uint8)
    level = np.clip(HOT + np.floor(2 * np.log2(n / max(8.0, total / HOT_SHARE))), 1, 100).astype(np.uint8)
    np.maximum.at(levels, slot & (len(levels) - 1), level)
    return levels


def _prefixes(docs: DataFrame, levels: np.ndarray, percent: int) -> DataFrame:
    """(node, token, place, hot): the prefix shingles of every set that can link to a different one.

    place holds the set's size and the shingle's position in the order, both
    rounded: 2% bands of the size, 1/1024 of the size.
    """
    def emit(batches):
        for b in text_slices(batches, "text"):
            out = []
            for s in shingle_sets(as_bytes(b.column("text"))):
                if percent * (len(s) + 1) > 100 * len(s):  # not even a set of one shingle more links: only equal sets do
                    continue
                need = least_overlap(len(s), percent)
                level = levels[(s & U64(len(levels) - 1)).astype(np.int64)]
                first = np.argsort((s >> U64(7)) | (level.astype(U64) << U64(57)), kind="stable")[:len(s) - need + COMMON]
                place = (int(np.log(len(s)) / np.log(BAND)) << 10) + np.arange(len(first)) * 1024 // len(s)
                out.append((np.full(len(first), _node(s)[0], np.int64), s[first].view(np.int64), place.astype(np.int32), level[first] >= HOT))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["node", "token", "place", "hot"])

    return docs.select("text").mapInArrow(emit, "node long, token long, place int, hot boolean")


def _possible(p: np.ndarray, q: np.ndarray, percent: int) -> np.ndarray:
    """Whether two sets may link if the shingle at these places is one of their first COMMON ones (size and position filter)."""
    low = [BAND ** (x >> 10) * 0.999 for x in (p, q)]
    rest = [BAND ** ((x >> 10) + 1) * 1.001 * (1 - (x & 1023) / 1024) + COMMON for x in (p, q)]
    return np.minimum(*rest) >= percent / (100 + percent) * (low[0] + low[1])


def _partners(place: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of one inverted list may link to another one of it; all of a long list."""
    if len(place) > LIST:
        return np.ones(len(place), bool)
    ok = _possible(place[:, None], place[None, :], percent)
    np.fill_diagonal(ok, False)
    return ok.any(1)


def _memberships(prefixes: DataFrame, percent: int) -> DataFrame:
    """(anchor, node): each node with the anchors of its prefix shingles, itself not among them.

    Rare shingles go through one sort; a list is the run of one token. Linked
    nodes share their first COMMON shingles' lists. If one of these lists is
    longer than SHORT, they meet under its anchor, its first node, once nodes
    without a possible partner in it have left. Otherwise they are a possible
    pair of COMMON short lists, so pairs of fewer (chance) are dropped; a pair
    is a block of its lesser node. Frequent shingles pass, spread over tasks by
    node, to an aggregate whose result is joined back; a skewed join is split.
    """
    def rows_of(kinds: list[tuple[int, list, list]]) -> pa.RecordBatch:
        a, b, k = [], [], []
        for kind, x, y in kinds:
            x, y = np.concatenate(x), np.concatenate(y)
            keep = (x != y) | (kind == _FREQUENT)
            a.append(x[keep])
            b.append(y[keep])
            k.append(np.full(int(keep.sum()), kind, np.int32))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (a, b, k)], names=["anchor", "node", "kind"])

    def runs(batches):
        held = None  # rows of the last list seen, which may go on
        long_list = None  # (token, anchor) of a list so long that its rows pass at once
        none = np.zeros(0, np.int64)
        for b in chain(batches, [None]):
            anchors, nodes, lesser, greater = [none], [none], [none], [none]
            if b is not None:
                now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
                if long_list is not None:
                    same = now[1] == long_list[0]
                    nodes.append(now[0][same])
                    anchors.append(np.full(int(same.sum()), long_list[1]))
                    now = [x[~same] for x in now]
                    if len(now[0]):
                        long_list = None
                held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if held is None or not len(held[0]):
                held = None
                yield rows_of([(_LIST, anchors, nodes)])
                continue
            node, token, place, hot = held
            new = np.ones(len(node), bool)  # repeated rows: copies
            new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
            node, token, place, hot = node[new], token[new], place[new], hot[new]
            begin = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            size = np.diff(np.concatenate([begin, [len(token)]]))
            whole = np.ones(len(begin), bool)
            held = None
            if b is not None and not hot[-1]:
                whole[-1] = False
                if size[-1] > LIST:
                    long_list = (token[-1], node[begin[-1]])
                    nodes.append(node[begin[-1]:])
                    anchors.append(np.full(size[-1], long_list[1]))
                else:
                    held = [x[begin[-1]:] for x in (node, token, place, hot)]
            rare = whole & ~hot[begin]
            two = begin[rare & (size == 2)]
            two = two[_possible(place[two], place[two + 1], percent)]
            lesser.append(node[two])
            greater.append(node[two + 1])
            for k in np.flatnonzero(rare & (size > 2)).tolist():
                span = slice(begin[k], begin[k] + size[k])
                own = node[span]
                if size[k] <= SHORT:
                    i, j = np.triu_indices(len(own), 1)
                    ok = _possible(place[span][i], place[span][j], percent)
                    lesser.append(own[i[ok]])
                    greater.append(own[j[ok]])
                else:
                    own = own[_partners(place[span], percent)]
                    anchors.append(np.repeat(own[:1], len(own)))
                    nodes.append(own)
            yield rows_of([(_LIST, anchors, nodes), (_PAIR, lesser, greater), (_FREQUENT, [token[hot]], [node[hot]])])

    spread = F.when(F.col("hot"), F.col("node")).otherwise(F.lit(0).cast("long"))
    rows = prefixes.repartition("token", spread).sortWithinPartitions("token", "node")
    seen = materialize(rows.mapInArrow(runs, "anchor long, node long, kind int"), "jaccard-lists")
    hot = seen.where(F.col("kind") == _FREQUENT).select(F.col("anchor").alias("token"), "node")
    lead = hot.groupBy("token").agg(F.min("node").alias("anchor"))
    hot = hot.join(lead, "token").where("anchor <> node").select("anchor", "node")
    pairs = seen.where(F.col("kind") == _PAIR).groupBy("anchor", "node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= COMMON)
    lists = seen.where(F.col("kind") == _LIST).select("anchor", "node")
    return lists.union(pairs.select("anchor", "node")).union(hot).distinct()


def _promising(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """rows (keys, node, settled, n, bits) without sizes and bitmaps, and whether each may link to another one of its group."""
    names = [*keys, "node", "settled"]

    def judge(batches):
        held = None
        for b in chain(batches, [None]):
            if b is not None:
                now = [c.to_numpy(zero_copy_only=False) for c in b.columns[:-1]] + [b.columns[-1].to_pylist()]
                held = now if held is None else [*(np.concatenate(x) for x in zip(held[:-1], now[:-1])), held[-1] + now[-1]]
            if held is None or not len(held[0]):
                continue
            new = np.zeros(len(held[0]), bool)
            new[0] = True
            for key in held[:len(keys)]:
                new[1:] |= key[1:] != key[:-1]
            begin = np.flatnonzero(new)
            end = np.append(begin[1:], len(new))
            done, size, bits = held, held[-2], held[-1]
            if b is not None:  # the last group may go on
                held = [x[begin[-1]:] for x in held]
                begin, end = begin[:-1], end[:-1]
            stop = int(end[-1]) if len(end) else 0
            good = np.zeros(stop, bool)
            for x, y in zip(begin.tolist(), end.tolist()):
                good[x:y] = True if y - x > MANY else may_link(size[x:y], bits[x:y], done[len(keys) + 1][x:y], percent)
            yield pa.RecordBatch.from_arrays([*(pa.array(c[:stop]) for c in done[:len(names)]), pa.array(good)], names=[*names, "good"])

    kinds = ", ".join(f"{c} {'boolean' if c == 'settled' else 'int' if c in ('part', 'turn') else 'long'}" for c in names)
    return rows.select(*names, "n", "bits").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(judge, f"{kinds}, good boolean")


def _payloads(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(doc_id, mark, blob): compressed texts of the documents in `needed` (doc_id, mark), and of a few others.

    A row that is repeated comes as often, so callers take one per (doc_id, mark).

    A bitmap of hash slots, of fixed size, keeps most others out of the join
    that follows; however many are needed, none of them is left out.
    """
    slot = F.pmod(F.xxhash64("doc_id", "mark"), F.lit(NEEDED_SLOTS))
    bitmap = np.zeros(NEEDED_SLOTS, bool)
    bitmap[needed.select(slot.alias("slot")).distinct().toArrow().column(0).to_numpy()] = True  # a row per slot at most
    bits = np.packbits(bitmap)

    def emit(batches):
        wanted = np.unpackbits(bits).astype(bool)
        squeeze = zstandard.ZstdCompressor(level=8)
        for b in batches:
            b = b.filter(pa.array(wanted[b.column("slot").to_numpy(zero_copy_only=False)]))
            blobs = [squeeze.compress(t) for t in as_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.array(blobs, pa.binary())],
                                             names=["doc_id", "mark", "blob"])

    rows = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    return rows.withColumn("slot", slot).mapInArrow(emit, "doc_id long, mark long, blob binary")


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])


def _search(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Search every group of (anchor, node, blob, settled): links (a, b, true), and what the anchor is not connected to (false)."""
    def search(group: pa.Table) -> pa.Table:
        anchor = group.column("anchor")[0].as_py()
        settled = dict(zip(group.column("node").to_pylist(), group.column("settled").to_pylist()))
        blobs = dict(zip(group.column("node").to_pylist(), group.column("blob").to_pylist()))
        nodes = sorted(blobs, key=lambda x: (x != anchor, x))
        open_blob = zstandard.ZstdDecompressor().decompress
        sets = shingle_sets([open_blob(blobs[x]) for x in nodes])
        links, known = block_links(sets, [i for i, x in enumerate(nodes) if settled[x]], percent)
        a, b = [nodes[x] for x, _ in links], [nodes[y] for _, y in links]
        out = [x for i, x in enumerate(nodes) if known.find(i) != known.find(0)] if nodes[0] == anchor else []
        return pa.table([a + [anchor] * len(out), b + out, [True] * len(a) + [False] * len(out)], schema=_FOUND)

    return rows.groupBy(*keys).applyInArrow(search, "a long, b long, linked boolean")


def links(docs: DataFrame, sized: DataFrame, levels: np.ndarray, percent: int = PERCENT, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(a, b) links between nodes that connect them as all their links do."""
    if percent < 100 and 100 // (100 - percent) - 1 < COMMON:
        raise ValueError(f"at {percent} percent the smallest sets that can link to others share fewer than {COMMON} shingles")
    members = _memberships(_prefixes(docs, levels, percent), percent)
    one_doc = sized.groupBy("node").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc_id"), "mark")).alias("doc"),
                                        F.first("n").alias("n"), F.first("bits").alias("bits"))
    members = materialize(members.join(one_doc.select("node", "n"), "node"), "jaccard-blocks")
    parts = members.groupBy("anchor").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("parts"))
    whole = members.join(parts, "anchor").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    lead = parts.select("anchor", F.col("anchor").alias("node"), F.lit(0).cast("long").alias("n"), "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    whole = whole.select("anchor", "node", "n", "parts", "part").union(lead)

    def promising(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        """By the bitmaps: sets that can link to no other one of their group need no text."""
        return materialize(_promising(rows.join(one_doc.select("node", "n", "bits"), "node"), keys, percent), name)

    def with_text(rows: DataFrame) -> DataFrame:
        rows = rows.join(one_doc, "node").select(*rows.columns, "doc.doc_id", "doc.mark")
        texts = _payloads(docs, rows.select("doc_id", "mark")).groupBy("doc_id", "mark").agg(F.any_value("blob").alias("blob"))
        return rows.join(texts, ["doc_id", "mark"])

    judged = promising(whole.select("anchor", "part", "node", F.lit(False).alias("settled")), ["anchor", "part"], "jaccard-near")
    cut = parts.where("parts > 1")
    cut_rows = judged.join(cut.select("anchor"), "anchor", "left_semi")
    leads = cut_rows.where(~F.col("good") & (F.col("node") == F.col("anchor"))).drop("good")  # a part is held against its anchor
    rows = with_text(judged.where("good").drop("good").union(leads.select("anchor", "part", "node", "settled")))
    found = materialize(_search(rows, ["anchor", "part"], percent), "jaccard-links")
    first = found.where("linked").select("a", "b")
    if cut.isEmpty():
        return first
    # blocks in several parts: what is not connected to the anchor in its part meets every part
    out = found.where("not linked").select(F.col("a").alias("anchor"), F.col("b").alias("node")).union(
        cut_rows.where(~F.col("good") & (F.col("node") != F.col("anchor"))).select("anchor", "node")).join(cut, "anchor")
    out = out.join(one_doc.select("node", "n"), "node")
    turns = out.groupBy("anchor").agg(F.ceil(F.sum("n") / block_shingles).cast("int").alias("turns"))
    out = out.join(turns, "anchor").withColumn("turn", F.pmod(F.xxhash64("node", F.lit(1)), F.col("turns")).cast("int"))
    queries = out.select("anchor", "node", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "turn",
                         F.lit(False).alias("settled"))
    others = whole.where("parts > 1").join(turns, "anchor").join(
        out.select("anchor", "node", F.lit(True).alias("is_out")), ["anchor", "node"], "left")
    others = others.select("anchor", "node", "part", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"),
                           F.col("is_out").isNull().alias("settled"))
    again = queries.union(others).groupBy("anchor", "part", "turn", "node").agg(F.min("settled").alias("settled"))
    keys = ["anchor", "part", "turn"]
    again = promising(again, keys, "jaccard-near-again").where("good").drop("good")
    return first.union(_search(with_text(again), keys, percent).where("linked").select("a", "b"))


def _rooted(docs: DataFrame, percent: int, block_shingles: int) -> DataFrame:
    """(doc_id, mark, n, root) of each document; root is null where the set is empty."""
    small_batches(docs.sparkSession)
    sized, levels = _sized(docs)
    nodes = sized.where("n > 0").groupBy("node").agg(F.min("proof").alias("p"), F.max("proof").alias("q"))
    if not nodes.where("p <> q").isEmpty():
        raise RuntimeError("two shingle sets share a 64-bit digest")
    root = materialize(components(links(docs, sized.where("n > 0"), levels, percent, block_shingles)), "jaccard-roots")
    return sized.join(root, "node", "left").select(
        "doc_id", "mark", "n", F.when(F.col("n") > 0, F.coalesce("root", "node")).alias("root"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                       block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    rows = _rooted(doc_text(docs, id_col, text_col), percent, block_shingles)
    least = rows.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rows.join(least, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
             block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """One document of each component, the least by (id, text hash), with all its columns; documents without words all stay."""
    rows = materialize(_rooted(doc_text(docs, id_col, text_col), percent, block_shingles), "jaccard-rows")
    chosen = rows.where("n > 0").groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("first"))
    key, mark, at = (free_name(docs, c) for c in ("kept_id", "kept_mark", "kept_at"))
    chosen = chosen.select(F.coalesce("first.doc_id", F.lit(NULL_ID)).alias(key), F.col("first.mark").alias(mark))
    has_word = F.coalesce(F.col(text_col).cast("string").rlike(WORD_RE), F.lit(False))
    keyed = docs.where(has_word).withColumn(key, F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID))).withColumn(
        mark, F.xxhash64(F.col(text_col).cast("string")))
    only = Window.partitionBy(key, mark).orderBy(F.lit(0))
    kept = keyed.join(chosen, [key, mark], "left_semi").withColumn(at, F.row_number().over(only)).where(F.col(at) == 1)
    return kept.select(*docs.columns).union(docs.where(~has_word))
