"""Centroid clustering of quantised vectors, each distinct vector once.

Vectors become integers, equal ones are grouped with their multiplicity, and Lloyd's
rounds run over the distinct ones.  A round is one pass: a task assigns its vectors and
sums them per cluster, weighted by multiplicity, in integers; only one row per cluster and
component leaves it.  What reaches the driver is the centroids, ``k`` times the
number of components.  At the end assignments are joined back to the ids, by
a join that adaptive execution splits where one vector holds many ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takepick.llm.common import Scratch

#: Components beyond it would not leave room for squared distances in 64 bits.
MOST = 1 << 27
CHUNK = 4096  # distinct vectors assigned at once


def quantise(vectors: pa.ListArray, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are whole vectors of ``dims`` finite components, and floor(scale * x) of theirs."""
    lengths = np.asarray(vectors.value_lengths().fill_null(0), np.int64)
    flat = vectors.flatten()  # without those of null rows
    nulls = np.asarray(flat.is_null())
    x = np.asarray(flat.fill_null(0), np.float64)
    bad = np.concatenate(([0], np.cumsum(nulls | ~np.isfinite(x))))
    ends = np.cumsum(lengths)
    good = (lengths == dims) & (bad[ends] == bad[ends - lengths])
    at = (ends - lengths)[good][:, None] + np.arange(dims)
    q = np.floor(x[at] * scale)
    if q.size and np.abs(q).max() > MOST:
        raise ValueError(f"a component times {scale} is beyond {MOST}: use a smaller scale")
    return np.flatnonzero(good), q.astype(np.int64)


def unpack(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid; of equally near ones the smaller number."""
    best, least = np.zeros(len(x), np.int32), np.full(len(x), np.iinfo(np.int64).max)
    for k, c in enumerate(centroids):
        d = x - c
        d = np.einsum("ij,ij->i", d, d)
        closer = d < least
        best[closer], least[closer] = k, d[closer]
    return best, least


def weighted_sums(x: np.ndarray, weight: np.ndarray) -> list[int]:
    """Sum of weight * component, exact whatever its size."""
    most = int(np.abs(x).max(initial=0)) * int(weight.max(initial=0)) * len(x)
    if most >= 1 << 62:
        x, weight = x.astype(object), weight.astype(object)
    return (weight @ x).tolist()


def sha256_of(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(
    rows: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = 1024,
    seed: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid (array), centroid_sha256.

    Vectors take part if they have exactly ``dims`` components, none null or
    non-finite; each becomes floor(scale * x).  Centroids start as the ``k`` vectors of smallest
    sha256 of "seed:id" (equal ids by their vectors; a null id is no digits), or as all if they
    are fewer, and may be equal to one another.  A vector belongs to the nearest centroid by squared Euclidean distance, the smaller
    number of equal ones.  Non-empty centroids move to the floor of their mean, empty
    ones stay.  Rows repeated with one id are rows of their own, and null ids are kept.  No vectors
    give no rows; other columns are ignored.  Components times ``scale`` beyond 2^27 are refused
    with an error, as distances would not fit 64 bits.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, q = quantise(batch.column(1), dims, scale)
            raw = q.astype("<i4").tobytes()
            n = 4 * dims
            keys = pa.array([raw[i * n : (i + 1) * n] for i in range(len(good))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(good)), keys], ["vec_id", "v"])

    with Scratch(rows.sparkSession) as s:
        source = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
        vectors = s.table(source.mapInArrow(pack, "vec_id long, v binary"))
        distinct = s.table(vectors.groupBy("v").agg(F.count(F.lit(1)).alias("n")))
        order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
        start = vectors.select(order.alias("h"), "v").orderBy("h", "v").limit(k).collect()
        centroids = np.array([np.frombuffer(r.v, "<i4") for r in start], np.int64).reshape(-1, dims)

        def sums(batches: Iterator[pa.RecordBatch], now: np.ndarray) -> Iterator[pa.RecordBatch]:
            total, count = [[0] * dims for _ in now], [0] * len(now)
            for batch in batches:
                for cut in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(cut, CHUNK)
                    x, weight = unpack(part.column(0), dims), np.asarray(part.column(1), np.int64)
                    mine, _ = nearest(x, now)
                    for c in np.unique(mine).tolist():
                        held = mine == c
                        total[c] = [a + b for a, b in zip(total[c], weighted_sums(x[held], weight[held]))]
                        count[c] += int(weight[held].sum())
            out = [(c, d, str(total[c][d]), count[c]) for c in range(len(now)) if count[c] for d in range(dims)]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["cluster", "at", "total", "n"])

        for _ in range(rounds if len(centroids) else 0):
            found = distinct.mapInArrow(lambda b, now=centroids: sums(b, now), "cluster int, at int, total string, n long")
            found = found.groupBy("cluster", "at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
            moved = centroids.copy()
            for r in found.collect():  # a row per cluster and component
                moved[r.cluster, r["at"]] = int(r.total) // r.n
            if (moved == centroids).all():
                break  # the rounds left would change nothing
            centroids = moved

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for cut in range(0, batch.num_rows, CHUNK):
                    part = batch.slice(cut, CHUNK)
                    mine, distance = nearest(unpack(part.column(0), dims), centroids)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(mine), pa.array(distance)], ["v", "n", "cluster", "distance"])

        assigned = s.table(distinct.mapInArrow(assign, "v binary, n long, cluster int, distance long"))
        own = F.sum(F.col("distance").cast("decimal(38,0)") * F.col("n")).cast("long").alias("cluster_inertia")
        inertia = {r.cluster: r.cluster_inertia for r in assigned.groupBy("cluster").agg(own).collect()}  # at most k rows
        told = [(c, d, sum(inertia.values()), centroids[c].tolist(), sha256_of(centroids[c])) for c, d in inertia.items()]
        of_cluster = rows.sparkSession.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
        back = vectors.join(assigned.drop("n"), "v").join(F.broadcast(of_cluster), "cluster")  # at most k rows
        return s.keep(back.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256"))
