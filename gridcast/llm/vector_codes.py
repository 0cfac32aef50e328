"""Vector code compression with Hilbert-sorted blocks (operator 13).

Vectors are cut into equal consecutive parts, and each part is replaced by the
number of the nearest of 256 codebook entries. Vectors are written once, in
chunks of rows; inside a chunk each part position is sorted along a Hilbert
curve and cut into flat blocks that store the least and greatest value of every
dimension (the box) and the sums.

In a round, no row of a block can be nearest to an entry whose least distance to
the box exceeds some other entry's greatest one, so the rest is the block's
shortlist. A shortlist of one takes the whole block by its stored sums; others
are decided by a small integer kernel over rows x shortlist. Results are exact:
the curve and the boxes only save work. Tasks send a row per part, entry and
dimension; only codebooks reach the driver.

Dropped are null vectors and those with a null or non-finite component; others
become integers floor(1024 * x). Codebooks start as the parts of the vectors with
the 256 smallest ids; each round assigns (ties: lower index) and replaces used
entries by the floor of the exact mean. A round that changes no entry is the last
one, as all later ones would equal it.

Defined results: equal ids stand in order of their vectors, a null id comes last
among the starts and is kept; repeated rows all count; fewer than 256 vectors
give fewer entries, no vector an empty table. The length of the vectors is the
commonest one that the number of parts divides (the longer of equally common
ones); kept vectors of other lengths cannot be coded and get a null code and
error, which count nothing in label_error. Components beyond 131 072 raise (see
`vectors`); of other columns only the three named are looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.vectors import exact_sum, finite, gathered, integers, matrix, packed, unpacked
from gridcast.session import materialize

PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Vectors in a chunk, rows in a flat block, bits of each dimension that the curve sees.
CHUNK_ROWS, BLOCK_ROWS, BITS = 1 << 15, 128, 4

_CHUNK = pa.schema([("ids", pa.list_(pa.int64())), ("labels", pa.list_(pa.string()))] + [
    (name, pa.list_(pa.binary())) for name in ("place", "values", "low", "high", "sums")])


# ---- the curve --------------------------------------------------------------

def hilbert_order(cells: np.ndarray, bits: int) -> np.ndarray:
    """Row order along the Hilbert curve through a grid of 2^bits cells per dimension.

    Gray-code form of the curve: from the highest bit down each axis flips or
    swaps the lower bits of the first one; the bits are then read across axes.
    """
    x = cells.T.astype(np.uint32)
    w = len(x)
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for i in range(w):
            hit = (x[i] >> np.uint32(level)) & np.uint32(1) == 1
            swap = np.where(hit, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(hit, low, swap)
            x[i] ^= swap
    for i in range(1, w):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint32(level)) & np.uint32(1) == 1, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= flip
    read = np.stack([(x[i] >> np.uint32(b)) & np.uint32(1) for b in range(bits - 1, -1, -1) for i in range(w)], 1).astype(np.uint8)
    read = np.packbits(read, axis=1)
    words = np.pad(read, ((0, 0), (0, -read.shape[1] % 8))).view(">u8").astype(np.uint64)
    return np.lexsort(words.T[::-1])


def curve_cells(x: np.ndarray, bits: int) -> np.ndarray:
    """Cell of each value in its dimension: cells hold about equally many rows."""
    at = (np.arange(1, 1 << bits) * len(x)) >> bits
    cuts = np.sort(x, axis=0)[at]
    return np.stack([np.searchsorted(cuts[:, j], x[:, j], "right") for j in range(x.shape[1])], 1)


def flat_blocks(x: np.ndarray, block_rows: int, bits: int = BITS) -> dict[str, np.ndarray]:
    """One part position of a chunk: rows in curve order (`place` tells which), boxes and sums of its blocks."""
    place = hilbert_order(curve_cells(x, bits), bits)
    values = x[place]
    begin = np.arange(0, len(x), block_rows)
    return {"place": place, "values": values, "low": np.minimum.reduceat(values, begin), "high": np.maximum.reduceat(values, begin),
            "sums": np.add.reduceat(values, begin)}


# ---- a round ------------------------------------------------------------------

def shortlists(low: np.ndarray, high: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """(blocks, entries): which entries may be the nearest one of some row in the block's box."""
    least = np.zeros((len(low), len(entries)), np.int64)
    most = np.zeros_like(least)
    for j in range(low.shape[1]):  # doubled, so that the middle of the box is an integer
        off = np.abs(2 * entries[None, :, j] - (low[:, j] + high[:, j])[:, None])
        half = (high[:, j] - low[:, j])[:, None]
        least += np.maximum(off - half, 0) ** 2
        most += (off + half) ** 2
    return least <= most.min(1, keepdims=True)


def nearest(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Index of the nearest entry of each row (ties: the lower one), in exact integers.

    Doubles hold the products where their sums stay under 2^52; longs do otherwise.
    """
    top = max(int(np.abs(rows).max()), int(np.abs(entries).max()), 1)
    kind = np.float64 if 4 * rows.shape[1] * top * top < 1 << 52 else np.int64
    c = entries.astype(kind)
    return ((c * c).sum(1) - 2 * (rows.astype(kind) @ c.T)).argmin(1)


def assign_part(part: dict[str, np.ndarray], entries: np.ndarray, block_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes in curve order, and the rows and component sums that each entry gets."""
    values, k = part["values"], len(entries)
    may = shortlists(part["low"], part["high"], entries)
    alone = may.sum(1) == 1
    codes = np.empty(len(values), np.int64)
    whole = may.argmax(1)
    size = np.diff(np.append(np.arange(0, len(values), block_rows), len(values)))
    sums = np.zeros((k, values.shape[1]), np.int64)
    np.add.at(sums, whole[alone], part["sums"][alone])
    codes[:] = np.repeat(whole, size)
    for b in np.flatnonzero(~alone).tolist():
        some = np.flatnonzero(may[b])
        at = slice(b * block_rows, (b + 1) * block_rows)
        codes[at] = some[nearest(values[at], entries[some])]
    rest = np.repeat(~alone, size)
    if rest.any():
        order = np.argsort(codes[rest], kind="stable")
        mine = codes[rest][order]
        begin = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        sums[mine[begin]] += np.add.reduceat(values[rest][order], begin)
    return codes, np.bincount(codes, minlength=k), sums


def _chunks(batches, width: int):
    """(ids, labels, parts) of each chunk."""
    for b in batches:
        for i in range(b.num_rows):
            row = {name: b.column(name)[i] for name in b.schema.names}
            cols = {name: row[name].as_py() for name in ("place", "values", "low", "high", "sums")}
            parts = [{name: unpacked(cols[name][p], None if name == "place" else width).astype(np.int64) for name in cols}
                     for p in range(len(cols["place"]))]
            yield row["ids"].values, row["labels"].values, parts


def block_table(rows: DataFrame, parts: int, chunk_rows: int, block_rows: int) -> DataFrame:
    """The chunks of rows (id, label, vector) as Hilbert-sorted blocks, written to the shared folder."""
    def run(batches):
        for t in gathered(batches, chunk_rows):
            x = matrix(t.column("vector").chunk(0))
            made = [flat_blocks(p, block_rows) for p in np.split(x, parts, axis=1)]
            yield pa.RecordBatch.from_pylist([{
                "ids": t.column("id").to_pylist(), "labels": t.column("label").to_pylist(),
                **{name: [packed(m[name]) for m in made] for name in ("place", "values", "low", "high", "sums")}}], schema=_CHUNK)

    names = ", ".join(f"{name} array<binary>" for name in ("place", "values", "low", "high", "sums"))
    return materialize(rows.mapInArrow(run, f"ids array<long>, labels array<string>, {names}"), "code-blocks")


def codebook_round(chunks: DataFrame, books: np.ndarray, block_rows: int) -> np.ndarray:
    """The codebooks (parts, entries, width) after one round; unused entries stay."""
    parts, k, width = books.shape

    def run(batches):
        n, total = np.zeros((parts, k), np.int64), np.zeros((parts, k, width), np.int64)
        for _, _, cut in _chunks(batches, width):
            for p, part in enumerate(cut):
                _, count, sums = assign_part(part, books[p], block_rows)
                n[p] += count
                total[p] += sums
        used = np.flatnonzero(n.ravel())
        values = np.hstack([n.reshape(-1, 1), total.reshape(-1, width)])[used]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(used, width + 1).astype(np.int32)),
                                          pa.array(np.tile(np.arange(width + 1), len(used)).astype(np.int32)), pa.array(values.ravel())],
                                         names=["entry", "place", "value"])

    rows = chunks.mapInArrow(run, "entry int, place int, value long").groupBy("entry", "place").agg(exact_sum("value").alias("value"))
    got: dict[int, dict[int, int]] = {}
    for r in rows.collect():  # parts * entries * (width + 1) rows at most
        got.setdefault(r.entry, {})[r.place] = int(r.value)
    out = books.reshape(-1, width).copy()
    for e, v in got.items():
        out[e] = [v[j + 1] // v[0] for j in range(width)]
    return out.reshape(books.shape)


def encode_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                   parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, chunk_rows: int = CHUNK_ROWS,
                   block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, np.ndarray]:
    """Rows vec_id, label, code, error in the shared folder, and the codebooks (parts, entries, width)."""
    if entries > 256:
        raise ValueError("a code has two hex digits: 256 entries at most")
    vector = F.col(vector_col)
    kept = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                        vector.cast("array<double>").alias("vector")).where(finite(vector))
    size = F.size("vector")
    common = kept.groupBy(size.alias("size")).agg(F.count("*").alias("n")).where((F.col("size") % parts == 0) & (F.col("size") > 0)).orderBy(
        F.desc("n"), F.desc("size")).first()
    dims = common["size"] if common else -1
    fits, odd = kept.where(size == dims), kept.where(size != dims).select(
        F.col("id").alias("vec_id"), "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if common is None:
        return odd, np.zeros((parts, 0, 0), np.int64)
    first = fits.orderBy(F.asc_nulls_last("id"), "vector").limit(entries).select("vector").collect()  # entries rows
    start = integers(np.array([r.vector for r in first], np.float64))
    books = np.stack(np.split(start, parts, axis=1))
    width = books.shape[2]
    chunks = block_table(fits, parts, chunk_rows, block_rows)
    for _ in range(rounds):
        moved = codebook_round(chunks, books, block_rows)
        if (moved == books).all():
            break
        books = moved

    def run(batches):
        for ids, labels, cut in _chunks(batches, width):
            codes, error = np.zeros((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
            for p, part in enumerate(cut):
                mine = assign_part(part, books[p], block_rows)[0]
                codes[part["place"], p] = mine
                error[part["place"]] += ((part["values"] - books[p][mine]) ** 2).sum(1)
            text = codes.tobytes().hex()
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array([text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]),
                                              pa.array(error)], names=["vec_id", "label", "code", "error"])

    coded = chunks.mapInArrow(run, "vec_id long, label string, code string, error long")
    return materialize(coded.unionByName(odd), "vector-codes"), books


def vector_codes(table: DataFrame, **options) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    The join to the sums per label is Spark's: it broadcasts them where their
    written size is small and splits a hot label's rows otherwise.
    """
    coded, books = encode_vectors(table, **options)
    sums = coded.groupBy(F.col("label").alias("of")).agg(exact_sum("error").cast("long").alias("label_error"))
    sign = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(materialize(sums, "label-errors"), F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(sign).alias("codebooks_sha256"))
