"""Centroid clustering with exact integers and a progressive nearest-centroid search.

Components become whole numbers, so sums, means and distances are exact and don't depend on how rows are dealt.
Vectors are stored as their Walsh-Hadamard transforms: coefficients are sums and differences of components, the
squared distance of two transforms is the vectors' times their length, and the first coefficients in the order of
sign changes already hold the coarse part of it. A search adds squared coefficient differences from coarse to fine.
Such a sum only grows, so a centroid whose sum exceeds the whole distance of another one is strictly worse and
goes; what is left is added up to the last coefficient, so ties are seen as ties.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

#: Vectors searched at once.
TILE = 2048
#: Scaled components must be below this, so that a squared distance of transforms fits in 64 bits.
LIMIT = 1 << 24


@dataclass(frozen=True)
class Settings:
    """``size``: components of a vector, a power of two; others are left out. ``scale``: a component x becomes floor(scale * x).

    ``clusters`` centroids start as the vectors whose number, after ``seed``, has the least SHA-256.
    """

    clusters: int = 40
    rounds: int = 5
    size: int = 64
    scale: int = 256
    seed: str = "2:"


def matrix(size: int) -> np.ndarray:
    """The Walsh-Hadamard matrix with rows from coarse to fine, by their number of sign changes."""
    rows = np.ones((1, 1), np.int64)
    while len(rows) < size:
        rows = np.block([[rows, rows], [rows, -rows]])
    if len(rows) != size:
        raise ValueError(f"{size} is no power of two")
    return rows[np.argsort((np.diff(rows, axis=1) != 0).sum(1), kind="stable")]


def levels(size: int) -> list[slice]:
    """Coefficients that are added at once: 4, then up to 8, 16, ..., all."""
    ends = [0, *(1 << k for k in range(2, size.bit_length()) if 1 << k <= size)]
    ends = ends if ends[-1] == size else [0, size]
    return [slice(a, b) for a, b in zip(ends, ends[1:])]


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each transformed vector, the first one of a tie, and the squared distance of the transforms."""
    steps = levels(x.shape[1])
    coarse = np.zeros((len(x), len(centroids)), np.int64)
    for k in range(steps[0].start, steps[0].stop):
        coarse += (x[:, k, None] - centroids[None, :, k]) ** 2
    guess = coarse.argmin(1)
    worst = ((x - centroids[guess]) ** 2).sum(1)  # the whole distance of the best guess
    of, to = np.nonzero(coarse <= worst[:, None])
    sums = coarse[of, to]
    for step in steps[1:]:
        sums += ((x[of, step] - centroids[to, step]) ** 2).sum(1)
        left = sums <= worst[of]
        of, to, sums = of[left], to[left], sums[left]
    order = np.lexsort((to, sums, of))  # every vector has its guess at least
    first = order[np.flatnonzero(np.diff(of[order], prepend=-1))]
    return to[first], sums[first]


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))


def transformed(df: DataFrame, id_col: str, vector: str, settings: Settings) -> DataFrame:
    """``id`` and ``w`` (the transform) of every vector of the right length without null or non-finite components."""
    h = matrix(settings.size)
    spread = (settings.size * LIMIT).bit_length()
    kind, number = ("array<int>", np.int32) if spread < 32 else ("array<long>", np.int64)
    x = F.col(vector).cast("array<double>")
    fits = (F.size(x) == settings.size) & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    usable = df.select(F.col(id_col).alias("id"), x.alias("x")).filter(F.coalesce(fits, F.lit(False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                whole = np.floor(part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, settings.size) * settings.scale)
                if np.abs(whole).max(initial=0) >= LIMIT:
                    raise ValueError(f"components of {LIMIT // settings.scale} or more: distances would not fit in 64 bits")
                yield pa.RecordBatch.from_arrays([part.column("id"), _lists((whole.astype(np.int64) @ h.T).astype(number))], names=["id", "w"])

    return usable.mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, w {kind}")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, TILE):
            part = batch.slice(at, TILE)
            yield part, part.column("w").flatten().to_numpy().reshape(-1, size).astype(np.int64)


def start(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The first centroids. Rows of one number are told apart by their components; the driver gets ``clusters`` rows."""
    told = F.concat(F.lit(settings.seed), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = vectors.select(F.sha2(told, 256).alias("hash"), "w").orderBy("hash", "w").limit(settings.clusters).collect()
    return np.array([r["w"] for r in rows], np.int64).reshape(-1, settings.size)


def sums(vectors: DataFrame, centroids: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """How many vectors each centroid has, and the sum of their transforms: one row for each centroid reaches the driver.

    A task adds up its own vectors first and hands on one row for each centroid.
    """
    names = [f"s{k}" for k in range(settings.size)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), settings.size + 1), np.int64)
        for _, x in _blocks(batches, settings.size):
            to, _ = nearest(x, centroids)
            order = np.argsort(to, kind="stable")
            begins = np.flatnonzero(np.diff(to[order], prepend=-1))
            total[to[order][begins], 1:] += np.add.reduceat(x[order], begins)
            total[:, 0] += np.bincount(to, minlength=len(centroids))
        some = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(c) for c in total[some].T.copy())], names=["cluster", "n", *names])

    parts = vectors.select("w").mapInArrow(run, "cluster long, n long, " + ", ".join(f"{c} long" for c in names))
    count, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), settings.size), np.int64)
    for r in parts.groupBy("cluster").agg(*(F.sum(c).alias(c) for c in ("n", *names))).collect():
        count[r["cluster"]], total[r["cluster"]] = r["n"], [r[c] for c in names]
    return count, total


def moved(centroids: np.ndarray, count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Transforms of the floored means; a centroid without vectors stays. The transform is its own inverse, but for the length."""
    h = matrix(centroids.shape[1])
    some = count > 0
    out = centroids.copy()
    means = (total[some] @ h // len(h)) // count[some, None]
    out[some] = means @ h.T
    return out


def assign(vectors: DataFrame, centroids: np.ndarray, settings: Settings) -> DataFrame:
    """``id``, ``cluster`` and ``distance`` (squared) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, settings.size):
            to, far = nearest(x, centroids)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(to.astype(np.int32)), pa.array(far // settings.size)], names=["id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"id {vectors.schema['id'].dataType.simpleString()}, cluster int, distance long")


def cluster_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``id_col``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every usable vector.

    Vectors that are null, of another length, or hold null or non-finite components are left out. Components of 65,536
    or more (with the present scale) are an error, since distances would not fit in a long. Every row counts, repeated
    ones too; a null number hashes like an empty one. With fewer vectors than clusters each starts one. An empty table
    gives no rows. Other input columns are left out, whatever their names.

    Only the centroids and one row of sums for each travel through the driver, whatever the number of vectors.
    """
    spark = df.sparkSession
    vectors = written(transformed(df, id_col, vector, settings), "transforms")
    centroids = start(vectors, settings)
    if not len(centroids):
        none = f"{id_col} {df.schema[id_col].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], none)
    for _ in range(settings.rounds):
        centroids = moved(centroids, *sums(vectors, centroids, settings))
    found = written(assign(vectors, centroids, settings), "assigned")
    own = {r["cluster"]: r["d"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    h = matrix(settings.size)
    plain = centroids @ h // settings.size
    told = [(k, own[k], sum(own.values()), hashlib.sha256(",".join(map(str, plain[k])).encode()).hexdigest()) for k in own]
    facts = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = found.join(F.broadcast(facts), "cluster")  # a row for each cluster
    return out.select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
