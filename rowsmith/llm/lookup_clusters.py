"""Centroid clustering by scalar lookup tables: exact integer k-means whose distances are table gathers and sums.

1. Vectors become integers ``floor(scale * x)``. A block of vectors is stored once as, per dimension, the integer values that
   occur in it and each vector's place among them.
2. A round tabulates, per dimension, occurring value and centroid, the squared difference: one small table a block. A vector's
   distances to all centroids are then the sum of one table row a dimension, gathered by its places; no difference is taken twice
   for the same value. Sums per centroid are counts of the table's rows times their values.
3. A round's result is ``k * dims`` sums, added up by Spark, so that nothing but centroids reaches the driver, and the vectors
   are never shuffled: a vector that fills a third of the table is no hot key.

Everything is in whole numbers, so a round does not depend on how the rows lie in tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowsmith.llm import vectors as V
from rowsmith.llm.common import stored

BLOCKS_SCHEMA = "ids array<long>, vals binary, ranges binary, places binary"


def _encode(dims: int, scale: int):
    """Rows (id, vector) to blocks: the values that occur, the range of each dimension, each vector's place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ints in V.blocks_of(batches, dims, scale):
            found = [np.unique(ints[:, d], return_inverse=True) for d in range(dims)]
            ranges = np.cumsum([0, *[len(v) for v, _ in found]]).astype(np.int32)
            places = np.stack([p for _, p in found]).astype(np.uint16)  # a block has fewer than 2 ** 16 rows
            packed = [np.concatenate([v for v, _ in found]), ranges, places]
            yield pa.RecordBatch.from_arrays(
                [V.as_list(block.column(0)), *[pa.array([x.tobytes()], pa.binary()) for x in packed]], ["ids", "vals", "ranges", "places"]
            )

    return run


def _decoded(row: dict, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, ranges = np.frombuffer(row["vals"], np.int64), np.frombuffer(row["ranges"], np.int32)
    return values, ranges, np.frombuffer(row["places"], np.uint16).reshape(dims, -1)


def table_distances(values: np.ndarray, ranges: np.ndarray, places: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (n, k) of a block's vectors to the centroids (k, dims), by table."""
    dims = len(places)
    dim_of = np.repeat(np.arange(dims), np.diff(ranges))
    table = np.square(values[:, None] - centroids.T[dim_of])  # value by centroid, all dimensions below each other
    out = np.zeros((places.shape[1], len(centroids)), np.int64)
    for d in range(dims):
        out += table[ranges[d] : ranges[d + 1]].take(places[d], axis=0)
    return out


def _nearest(distances: np.ndarray) -> np.ndarray:
    return distances.argmin(axis=1)  # the first of equals: ties go to the smaller number


def _sums_of(centroids: np.ndarray, dims: int):
    """Blocks to (cluster, dim, s, n): per task, the sums of the vectors nearest to each centroid."""
    k = len(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                values, ranges, places = _decoded(row, dims)
                near = _nearest(table_distances(values, ranges, places, centroids))
                counts += np.bincount(near, minlength=k)
                for d in range(dims):
                    own = values[ranges[d] : ranges[d + 1]]
                    often = np.bincount(near * len(own) + places[d], minlength=k * len(own)).reshape(k, -1)
                    sums[:, d] += often @ own
        cluster, dim = np.divmod(np.arange(k * dims), dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (cluster.astype(np.int32), dim.astype(np.int32), sums.ravel(), counts[cluster])], ["cluster", "dim", "s", "n"]
        )

    return run


def _assigned(centroids: np.ndarray, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.select(["vals", "ranges", "places"]).to_pylist()):
                distances = table_distances(*_decoded(row, dims), centroids)
                near = _nearest(distances)
                columns = [
                    batch.column(0).slice(i, 1).flatten(),
                    pa.array(near.astype(np.int32)),
                    pa.array(distances[np.arange(len(near)), near]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return run


def first_centroids(rows: DataFrame, k: int, scale: int, salt: str) -> np.ndarray:
    """The ``k`` vectors of the smallest sha256 of ``salt:id``, ascending; rows without an id last, ties by vector."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")).cast("binary"), 256)
    least = rows.select(order.alias("hash"), "vector").orderBy(F.col("hash").asc_nulls_last(), "vector").limit(k).collect()
    return V.integers(np.array([r.vector for r in least], np.float64), scale)


def cluster_vectors(
    table: DataFrame,
    k: int = 8,
    rounds: int = 10,
    *,
    dims: int = 64,
    scale: int = 1024,
    salt: str = "3",
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """One row per kept row of ``table``: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Kept are vectors of exactly ``dims`` components, none null or not finite. ``k`` centroids start as the vectors of the
    smallest ``sha256(salt:id)``; each of ``rounds`` rounds gives every vector to the nearest centroid and moves every centroid that
    has vectors to their componentwise floor of the mean; then vectors are given out once more.

    Ties go to the smaller cluster. Repeated rows and repeated ids are rows of their own; a null id stays null and its row
    starts no cluster while others can. With fewer kept rows than ``k`` there are as many clusters as rows; an empty table, and one without a
    kept row, give no rows. Components beyond 2**27 / scale raise an error (a distance would not fit a long). Other columns are not read.
    """
    rows = V.whole_vectors(table, id_col, vec_col, dims)
    centroids = first_centroids(rows, k, scale, salt)
    schema = "vec_id long, cluster int, distance long"
    out = schema + ", cluster_inertia long, inertia long, centroid_sha256 string"
    if not len(centroids):
        return table.sparkSession.createDataFrame([], out)
    blocks = stored(rows.mapInArrow(_encode(dims, scale), BLOCKS_SCHEMA), "clusters-blocks")
    for _ in range(rounds):
        parts = blocks.select("vals", "ranges", "places").mapInArrow(_sums_of(centroids, dims), "cluster int, dim int, s long, n long")
        found = parts.groupBy("cluster", "dim").agg(V.exact_sum("s").alias("s"), F.sum("n").alias("n")).collect()  # k * dims rows
        sums, counts = np.zeros(centroids.shape, object), np.zeros(len(centroids), object)
        for r in found:
            sums[r.cluster, r.dim], counts[r.cluster] = int(r.s), int(r.n)
        centroids = V.floor_means(sums, counts, centroids.astype(object)).astype(np.int64)
    assigned = stored(blocks.mapInArrow(_assigned(centroids, dims), schema), "clusters-assigned")
    inertia = {r.cluster: int(r.s) for r in assigned.groupBy("cluster").agg(V.exact_sum("distance").alias("s")).collect()}  # k rows
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    by_cluster = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))])
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(by_cluster, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.get(F.array(*map(F.lit, digests)), F.col("cluster")).alias("centroid_sha256"),
    )
