"""Centroid clustering by a tournament of bisecting planes, in whole numbers.

A vector is nearer to centroid j than to centroid i exactly if

    2 x . (c_j - c_i)  >  |c_j|^2 - |c_i|^2

so the normals 2 (c_j - c_i) and the thresholds of all pairs i < j are worked out once
a round and sent to every task. The winner so far starts with number 0 and meets
numbers 1, 2, ... in turn: one sign test each, k - 1 in all. The winner so far always
has the smaller number, so it stays unless the test is above zero, and equal distances
go to the smaller number. No distance is computed before the last assignment.

Components are floor(scale * x) with x as a double, which is exact: scale is a power of
two. Where a test could leave 64 bits the batch is computed with Python's integers.
Sums leave a task as one row per cluster: a count and, per component, limbs of 32 bits
(one limb of 64 where the sums of all rows fit), so they are added up by Spark and are
exact at any size. A round's only result is k centroids. A round that changes no
centroid ends the rounds, since the rest would change none either.

Memory: a task holds a batch and k (k - 1) / 2 normals; the driver k centroids.

Defined results: vectors that are null, of another length, or hold null or non-finite
components take no part. The first centroids are the vectors with the smallest SHA-256
of ``<seed>:<id>``, a null id as the empty text, equal ids by their components; with
fewer than k vectors there are as many centroids as vectors. Repeated rows are vectors
of their own. A distance or sum beyond the range of a long is cut to it. Other columns
aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktide.workspace import materialise

_SAFE = 2**62
_LIMIT = 2**63 - 1
_LIMB = 32


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, dim: int, scale: int) -> DataFrame:
    """(id, v) of the rows that take part; v holds whole numbers as doubles."""
    if scale < 1 or scale & (scale - 1):
        raise ValueError("the scale must be a power of two, so that products are exact")
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double") * scale) < float("inf")))
    rows = df.where((F.size(x) == dim) & F.coalesce(finite, F.lit(False)))
    return rows.select(F.col(id_col).alias("id"), F.transform(x, lambda e: _floor(e.cast("double") * scale)).alias("v"))


def _floor(x: F.Column) -> F.Column:
    """The floor as a double; doubles from 2^53 on are whole, and the built-in floor gives a long."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def first_centroids(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest hash, in its order."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    chosen = rows.select(F.sha2(text, 256).alias("hash"), "v").orderBy("hash", "v").limit(k).collect()
    return [[int(x) for x in r.v] for r in chosen]


class Tournament:
    """Normals and thresholds of all pairs of centroids, and the winner for each vector of a batch."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = np.array(centroids, object)
        k = len(centroids)
        squares = (self.centroids**2).sum(axis=1)
        self.pair = np.zeros((k, k), np.int64)
        self.first, self.second = np.triu_indices(k, 1)
        self.pair[self.first, self.second] = np.arange(len(self.first))
        self.normals = 2 * (self.centroids[self.second] - self.centroids[self.first])
        self.thresholds = squares[self.second] - squares[self.first]
        self.reach = max([0, *map(abs, self.normals.ravel().tolist())])
        self.farthest = max([0, *map(abs, self.thresholds.tolist())])
        self.most = max([0, *map(abs, self.centroids.ravel().tolist())])
        if self.reach < _SAFE and self.farthest < _SAFE:
            self.small = self.normals.astype(np.int64), self.thresholds.astype(np.int64), self.centroids.astype(np.int64)

    def _fits(self, most: int) -> bool:
        wide = self.centroids.shape[1]
        return self.reach * most * wide + self.farthest < _SAFE and (most + self.most) ** 2 * wide < _SAFE

    def batch(self, flat: np.ndarray) -> np.ndarray:
        """The vectors of a batch as integers of the narrowest exact kind."""
        rows = flat.reshape(-1, self.centroids.shape[1])
        most = int(np.abs(rows).max(initial=0))
        return rows.astype(np.int64) if self._fits(most) else np.array([[int(x) for x in r] for r in rows], object)

    def winners(self, rows: np.ndarray) -> np.ndarray:
        exact = rows.dtype == object
        normals, thresholds, _ = (self.normals, self.thresholds, None) if exact else self.small
        best = np.zeros(len(rows), np.int64)
        for j in range(1, len(self.centroids)):
            pair = self.pair[best, j]
            beaten = (rows * normals[pair]).sum(axis=1) > thresholds[pair]
            best[beaten.astype(bool)] = j
        return best

    def distances(self, rows: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Squared distances to the winners, cut to the range of a long."""
        if rows.dtype != object:
            return ((rows - self.small[2][best]) ** 2).sum(axis=1)
        far = ((rows - self.centroids[best]) ** 2).sum(axis=1)
        return np.array([min(_LIMIT, int(d)) for d in far], np.int64)


def _flat(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False)


def _limbs(value: int, n: int) -> list[int]:
    """``value`` in limbs of 32 bits, the lowest first; the last keeps the sign."""
    return [(value >> (_LIMB * k)) & (2**_LIMB - 1) for k in range(n - 1)] + [value >> (_LIMB * (n - 1))]


def _summer(centroids: list[list[int]], limbs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        game = Tournament(centroids)
        k, dim = game.centroids.shape
        sums, counts = np.zeros((k, dim), object), np.zeros(k, np.int64)
        for batch in batches:
            rows = game.batch(_flat(batch))
            best = game.winners(rows)
            counts += np.bincount(best, minlength=k)
            for j in np.unique(best):
                sums[j] += rows[best == j].astype(object).sum(axis=0) if rows.dtype == object else _sum(rows[best == j])
        used = np.flatnonzero(counts)
        cells = [[x for value in sums[j] for x in _limbs(int(value), limbs)] for j in used]
        yield pa.RecordBatch.from_pydict(
            {
                "cluster": pa.array(used, pa.int32()),
                "n": pa.array(counts[used], pa.int64()),
                "cells": pa.array(cells, pa.list_(pa.int64())),
            }
        )

    return run


def _sum(rows: np.ndarray) -> np.ndarray:
    """Exact sums of a batch, whose values may fill 62 bits: high and low halves are added apart."""
    high = (rows >> _LIMB).sum(axis=0).astype(object)
    return high * 2**_LIMB + (rows & (2**_LIMB - 1)).sum(axis=0).astype(object)


def _moved(rows: DataFrame, centroids: list[list[int]], limbs: int) -> list[list[int]]:
    """The centroids after one round: floors of the means, empty ones as they were."""
    wide = len(centroids[0]) * limbs
    parts = rows.select("v").mapInArrow(_summer(centroids, limbs), "cluster int, n long, cells array<long>")
    sums = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("cells")[i]).alias(f"c{i}") for i in range(wide)])
    after = [list(c) for c in centroids]
    for row in sums.collect():  # k rows at most
        cells = row[2:]
        totals = [sum(cells[d * limbs + j] << (_LIMB * j) for j in range(limbs)) for d in range(len(centroids[0]))]
        after[row.cluster] = [t // row.n for t in totals]
    return after


def train(rows: DataFrame, k: int, rounds: int, seed: int) -> list[list[int]]:
    """The centroids of ``whole_vectors`` after ``rounds`` rounds."""
    facts = rows.agg(F.count("*").alias("n"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    centroids = first_centroids(rows, k, seed)
    most = int(facts.most or 0)
    limbs = 1 if most * facts.n < _SAFE else 2 + (most * facts.n).bit_length() // _LIMB
    for _ in range(rounds if centroids else 0):
        after = _moved(rows, centroids, limbs)
        if after == centroids:
            break
        centroids = after
    return centroids


def assign(rows: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(id, cluster, distance) of every row."""
    kind = next(f.dataType.simpleString() for f in rows.schema if f.name == "id")
    if not centroids:
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        game = Tournament(centroids)
        for batch in batches:
            given = game.batch(_flat(batch))
            best = game.winners(given)
            far = game.distances(given, best)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(best, pa.int32()), pa.array(far, pa.int64())], ["id", "cluster", "distance"]
            )

    return rows.mapInArrow(run, f"id {kind}, cluster int, distance long")


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dim: int = 64, k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1_024
) -> tuple[DataFrame, list[list[int]]]:
    """Per vector: id, cluster, distance, cluster_inertia, inertia, centroid_sha256; and the centroids."""
    rows = materialise(whole_vectors(df, id_col, vector_col, dim, scale), "whole_vectors")
    centroids = train(rows, k, rounds, seed)
    assigned = materialise(assign(rows, centroids), "assigned")
    per_cluster = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}

    def cut(total) -> F.Column:
        return F.lit(min(_LIMIT, int(total))).cast("long")

    def of_cluster(values: dict) -> F.Column:
        pairs = [x for j, value in values.items() for x in (F.lit(j), value)]
        return F.element_at(F.create_map(*pairs), F.col("cluster")) if pairs else F.lit(None)

    return assigned.select(
        "id", "cluster", "distance",
        of_cluster({j: cut(t) for j, t in per_cluster.items()}).cast("long").alias("cluster_inertia"),
        cut(sum(per_cluster.values())).alias("inertia"),
        of_cluster({j: F.lit(centroid_digest(c)) for j, c in enumerate(centroids)}).cast("string").alias("centroid_sha256"),
    ), centroids
