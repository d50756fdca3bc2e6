"""Centroid clustering of integer vectors over a stored matrix of dot products that is brought up to date by differences.

Squared distance is |v|^2 - 2 v.c + |c|^2. For every vector its exact dot products with all centroids are stored, in the shared
folder. When centroids move, only the components that changed are multiplied and added: nothing for a centroid that stayed,
little for one that hardly moved. Then the nearest centroid is found anew. A round reads the stored matrix once, writes the
next one and gives sums by cluster, one row for each task and cluster, that Spark adds; the driver holds the centroids only.
All numbers are integers, so results do not depend on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import discard, new_folder, tidied

COMPONENTS = 64
SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2
#: Components beyond this are an error: a squared distance over 64 of them would no longer fit 64 bits.
LARGEST = 1 << 27


@dataclass
class Clustering:
    """`assigned`: (vec_id, v, dots, cluster, distance). `centroids` after the last round. `counts`, `inertias` by cluster."""

    assigned: DataFrame
    centroids: list[list[int]]
    counts: list[int]
    inertias: list[int]


def whole_vectors(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): vectors of exactly so many components, none null or non-finite, each as floor(scale * x)."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") == components) & finite)

    def whole(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < LARGEST, F.floor(y)).otherwise(F.raise_error(F.lit(f"component beyond {LARGEST} / {scale}")).cast("long")).cast("int")

    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", whole).alias("v"))


def first_centroids(vectors: DataFrame, k: int = CENTROIDS, seed: int = SEED) -> list[list[int]]:
    """The k vectors whose ids have the smallest SHA-256 with the seed; equal ids in the order of their components."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [list(r.v) for r in vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(k).collect()]


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(matrix: np.ndarray, of: pa.DataType) -> pa.ListArray:
    ends = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(matrix.reshape(-1), of))


STATE = "vec_id long, v array<int>, dots array<long>, cluster int, distance long"


def _step(moved: np.ndarray, centroids: np.ndarray):
    """Brings the dot products up to date by the components that `moved`, and assigns every vector anew."""
    changes = [(k, at, moved[k, at]) for k in range(len(moved)) if len(at := np.flatnonzero(moved[k]))]
    norms = (centroids * centroids).sum(axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), centroids.shape[1])
            known = "dots" in batch.schema.names
            dots = _matrix(batch.column("dots"), len(centroids)) if known else np.zeros((len(v), len(centroids)), dtype=np.int64)
            for k, at, by in changes:
                dots[:, k] += v[:, at] @ by
            score = norms - 2 * dots
            cluster = score.argmin(axis=1)  # the first of equal ones
            distance = score[np.arange(len(v)), cluster] + (v * v).sum(axis=1)
            columns = [batch.column("vec_id"), batch.column("v"), _lists(dots, pa.int64()), pa.array(cluster, pa.int32()), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "dots", "cluster", "distance"])

    return run


def _partial_sums(k: int, width: int):
    """For each cluster met in a task one row of sums: components, then the number of vectors, then their distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, width + 2), dtype=object)
        for batch in batches:
            v = _matrix(batch.column("v"), width)
            cluster, distance = (batch.column(c).to_numpy() for c in ("cluster", "distance"))
            for c in np.unique(cluster):
                here = cluster == c
                # distances are added in halves of 32 bits, so that no sum leaves 64 bits
                far = (int((distance[here] >> 32).sum()) << 32) + int((distance[here] & 0xFFFFFFFF).sum())
                sums[c] += np.array([*v[here].sum(axis=0).tolist(), int(here.sum()), far], dtype=object)
        met = [c for c in range(k) if sums[c, width]]
        rows = [(c, j, str(s)) for c in met for j, s in enumerate(sums[c])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.string()))], names=["cluster", "j", "s"])

    return run


def _summed(state: DataFrame, k: int, width: int) -> list[list[int]]:
    """Exact sums by cluster: components, number, distances. At most k * (width + 2) rows reach the driver."""
    parts = state.select("v", "cluster", "distance").mapInArrow(tidied(_partial_sums(k, width)), "cluster int, j int, s string")
    out = [[0] * (width + 2) for _ in range(k)]
    for r in parts.groupBy("cluster", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        out[r.cluster][r.j] = int(r.s)
    return out


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, components: int = COMPONENTS, scale: int = SCALE
) -> Clustering:
    """Assigns the vectors (vec_id, embedding) to k centroids that are replaced `rounds` times by floored means.

    Left out are null vectors, those of another length and those with a null or non-finite component. A component of 2^27 / scale
    or more is an error. Repeated rows, and rows that share an id, count as often as they stand there; a null id stays null and
    is hashed as an empty text. Ties go to the smaller centroid; a centroid without vectors stays where it is. With fewer than
    k vectors there are as many centroids as vectors, and an empty table gives no rows. Other columns are not looked at.

    Of the stored matrices, each is deleted once the next one and its sums are there; the last stays.
    """
    spark = vectors.sparkSession

    def store(df: DataFrame) -> tuple[DataFrame, str]:
        path = new_folder(spark, "clusters")
        df.write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path), path

    state, path = store(whole_vectors(vectors, components, scale))
    start = first_centroids(state, k, seed)
    centroids = np.array(start, dtype=np.int64).reshape(len(start), components)
    if not start:
        return Clustering(spark.createDataFrame([], STATE), [], [], [])
    moved = centroids
    for r in range(rounds + 1):
        following, path_after = store(state.mapInArrow(tidied(_step(moved, centroids)), STATE))
        sums = _summed(following, len(start), components)
        discard(spark, path)
        state, path = following, path_after
        if r < rounds:
            after = [[x // row[components] for x in row[:components]] if row[components] else old for row, old in zip(sums, centroids.tolist())]
            moved, centroids = np.array(after, dtype=np.int64) - centroids, np.array(after, dtype=np.int64)
    return Clustering(state, centroids.tolist(), [row[components] for row in sums], [row[components + 1] for row in sums])


def digest(found: Clustering) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    spark, total = found.assigned.sparkSession, sum(found.inertias)
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.centroids]
    rows = [(k, far, total, name) for k, (far, name) in enumerate(zip(found.inertias, hashes))]
    about = F.broadcast(spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"))  # k rows
    return found.assigned.select("vec_id", "cluster", "distance").join(about, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
