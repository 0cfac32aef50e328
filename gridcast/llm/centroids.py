"""Centroid clustering over subvector dictionaries (operator 11).

Vectors are written once, in chunks of rows, as codes: a chunk cuts the
dimensions into blocks and keeps for each block a dictionary of its distinct
subvectors and one code a vector. Neighbouring blocks merge while the merged
dictionary costs less than the lookups that it saves, so that chunks with
repeated vectors get wide blocks and chunks without get narrow ones. Nothing is
lost: the codes give back the integers.

A round takes each dictionary's exact distances to all centroids once, adds them
up by code, and turns counts of (code, cluster) into sums through the dictionary.
Tasks send a row per cluster and dimension; only centroids reach the driver.

Kept are vectors with exactly `dims` components, none null or non-finite, as
integers floor(1024 * x). Centroids start as the k vectors with the smallest
sha256 of `<seed>:<id>`; each round assigns to the nearest (ties: smaller
number) and replaces non-empty centroids by the floor of the exact mean. A round
that changes no centroid is the last one, as all later ones would equal it.

Defined results: equal ids stand in order of their vectors, a null id comes last
among the starts and is kept; repeated rows all count; fewer than k vectors give
fewer centroids, no vector an empty table; components beyond 131 072 raise (see
`vectors`); of other columns only the two named are looked at.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.vectors import exact_sum, finite, gathered, integers, matrix, packed, unpacked
from gridcast.session import materialize

DIMS, CLUSTERS, ROUNDS, SEED = 64, 8, 10, 3
#: Vectors in a chunk.
CHUNK_ROWS = 1 << 15

Block = tuple[int, np.ndarray, np.ndarray]

_CHUNK = pa.schema([("ids", pa.list_(pa.int64())), ("first", pa.list_(pa.int32())), ("width", pa.list_(pa.int32())),
                    ("subvectors", pa.list_(pa.binary())), ("codes", pa.list_(pa.binary()))])


def encode(x: np.ndarray) -> list[Block]:
    """(first dimension, distinct subvectors, code of each row) of blocks that cover all dimensions."""
    blocks: list[Block] = []
    for i in range(x.shape[1]):
        distinct, codes = np.unique(x[:, i], return_inverse=True)
        blocks.append((i, distinct[:, None], codes))
    width = 1
    while True:
        by_first = {b[0]: b for b in blocks if b[1].shape[1] == width}
        merged = []
        for i in sorted(by_first):
            a, b = by_first[i], by_first.get(i + width)
            if i % (2 * width) or b is None:
                continue
            na, nb = len(a[1]), len(b[1])
            if na and max(na, nb) * 2 * width - (na + nb) * width >= len(x):
                continue  # the merged dictionary has max(na, nb) entries at least
            pairs, codes = np.unique(a[2] * nb + b[2], return_inverse=True)
            if len(pairs) * 2 * width - (na + nb) * width < len(x):
                merged.append((i, np.hstack([a[1][pairs // max(nb, 1)], b[1][pairs % max(nb, 1)]]), codes))
        if not merged:
            return sorted(blocks, key=lambda b: b[0])
        gone = {i + d for i, *_ in merged for d in (0, width)}
        blocks = [b for b in blocks if b[0] not in gone] + merged
        width *= 2


def distances(blocks: list[Block], centroids: np.ndarray) -> np.ndarray:
    """Squared distances (rows, centroids): partial ones per dictionary entry, added up by code."""
    total = np.zeros((len(blocks[0][2]), len(centroids)), np.int64)
    for first, sub, codes in blocks:
        part = np.zeros((len(sub), len(centroids)), np.int64)
        for j in range(sub.shape[1]):
            part += (sub[:, j:j + 1] - centroids[None, :, first + j]) ** 2
        total += part[codes]
    return total


def sums(blocks: list[Block], cluster: np.ndarray, k: int, dims: int) -> np.ndarray:
    """Sum of the vectors of each cluster, from how often each code occurs in it."""
    out = np.zeros((k, dims), np.int64)
    for first, sub, codes in blocks:
        n = np.bincount(codes * k + cluster, minlength=len(sub) * k).reshape(-1, k)
        out[:, first:first + sub.shape[1]] = n.T @ sub
    return out


def _chunks(batches):
    """(ids, blocks) of each encoded chunk."""
    for b in batches:
        for i in range(b.num_rows):
            row = {name: b.column(name)[i] for name in b.schema.names}
            width = row["width"].as_py()
            blocks = [(f, unpacked(s, w).astype(np.int64), unpacked(c).astype(np.int64)) for f, w, s, c in zip(
                row["first"].as_py(), width, row["subvectors"].as_py(), row["codes"].as_py())]
            yield row["ids"].values, blocks


def encode_vectors(rows: DataFrame, dims: int, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The table of encoded chunks of rows (id, vector), written to the shared folder."""
    def run(batches):
        for t in gathered(batches, chunk_rows):
            blocks = encode(matrix(t.column("vector").chunk(0)))
            yield pa.RecordBatch.from_pylist([{
                "ids": t.column("id").to_pylist(), "first": [b[0] for b in blocks], "width": [b[1].shape[1] for b in blocks],
                "subvectors": [packed(b[1]) for b in blocks], "codes": [packed(b[2]) for b in blocks]}], schema=_CHUNK)

    return materialize(rows.mapInArrow(run, "ids array<long>, first array<int>, width array<int>, subvectors array<binary>, "
                                            "codes array<binary>"), "centroid-codes")


def assign_round(encoded: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[int]]]:
    """Rows, inertia and component sums of each cluster under the nearest centroids (a row per cluster and dimension)."""
    k, dims = centroids.shape

    def run(batches):
        n, inertia, total = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, blocks in _chunks(batches):
            d = distances(blocks, centroids)
            cluster = d.argmin(1)
            n += np.bincount(cluster, minlength=k)
            np.add.at(inertia, cluster, d[np.arange(len(d)), cluster])
            total += sums(blocks, cluster, k, dims)
        values = np.hstack([n[:, None], inertia[:, None], total])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(k), dims + 2).astype(np.int32)),
                                          pa.array(np.tile(np.arange(dims + 2), k).astype(np.int32)), pa.array(values.ravel())],
                                         names=["cluster", "place", "value"])

    rows = encoded.mapInArrow(run, "cluster int, place int, value long").groupBy("cluster", "place").agg(exact_sum("value").alias("value"))
    out = [[0] * (dims + 2) for _ in range(k)]
    for r in rows.collect():  # k * (dims + 2) rows
        out[r.cluster][r.place] = int(r.value)
    return [r[0] for r in out], [r[1] for r in out], [r[2:] for r in out]


def start_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """Integers of the k vectors with the smallest sha256 of `seed:id`."""
    first = rows.orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256).asc_nulls_last(), "vector").limit(k)
    return integers(np.array([r.vector for r in first.select("vector").collect()], np.float64))


def cluster_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS,
                    k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    vector = F.col(vector_col)
    rows = table.select(F.col(id_col).cast("long").alias("id"), vector.cast("array<double>").alias("vector")).where(
        finite(vector) & (F.size(vector) == dims))
    centroids = start_centroids(rows, k, seed)
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return table.sparkSession.createDataFrame([], schema)
    encoded = encode_vectors(rows, dims, chunk_rows)
    for _ in range(rounds):
        n, _inertia, total = assign_round(encoded, centroids)
        moved = np.array([[t // c for t in row] if c else old.tolist() for row, c, old in zip(total, n, centroids)], np.int64)
        if (moved == centroids).all():
            break
        centroids = moved
    _, inertia, _ = assign_round(encoded, centroids)
    signs = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def run(batches):
        for ids, blocks in _chunks(batches):
            d = distances(blocks, centroids)
            cluster = d.argmin(1)
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(d[np.arange(len(d)), cluster])],
                                             names=["vec_id", "cluster", "distance"])

    def per_cluster(values: list[str], kind: str) -> Column:
        return F.element_at(F.array(*(F.lit(v) for v in values)), F.col("cluster") + 1).cast(kind)

    return encoded.mapInArrow(run, "vec_id long, cluster int, distance long").select(
        "*", per_cluster([str(v) for v in inertia], "long").alias("cluster_inertia"),
        F.lit(str(sum(inertia))).cast("long").alias("inertia"), per_cluster(signs, "string").alias("centroid_sha256"))
