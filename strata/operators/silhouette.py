"""Exact silhouette with Euclidean distance for any number of points (M4).

A point's silhouette needs its mean distance to its own cluster and to the
nearest other one. There is no decomposition by cluster sums, so distances are
added up pair by pair, in tiles:

* points of one cluster are packed into tiles of ``TILE`` rows, written once;
* each cluster has a pivot (its mean) and a mean radius. By the triangle inequality
  the mean distance from a point to a cluster lies within the radius of its distance
  to the pivot, so most clusters are ruled out as the nearest other one; a tile
  is only held against its own cluster and those that are left for some of its points;
* a task holds two tiles at a time and hands on one sum per point; the sums of a
  tile are added up as they come.

The driver sees the pivots and the numbers of the tiles only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.priority import materialize

TILE = 4096
BLOCK = 256

TILES = "c int, tile long, n int, data binary"


def _matrix(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float64).reshape(n, -1)


def _tiles(size: int, batches):
    held: dict[int, list[np.ndarray]] = {}
    base, made = TaskContext.get().partitionId() << 32, 0

    def packed(c, rows):
        nonlocal made
        made += 1
        return pa.RecordBatch.from_pydict(
            {"c": pa.array([c], pa.int32()), "tile": pa.array([base + made], pa.int64()),
             "n": pa.array([len(rows)], pa.int32()), "data": pa.array([np.stack(rows).tobytes()], pa.binary())})

    for batch in batches:
        for x, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = held.setdefault(c, [])
            rows.append(np.array(x, dtype=np.float64))
            if len(rows) == size:
                yield packed(c, held.pop(c))
    for c, rows in held.items():
        yield packed(c, rows)


def _sums(batches):
    """Rows (c, n, sums of coordinates)."""
    for batch in batches:
        for c, n, data in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            yield pa.RecordBatch.from_pydict({"c": pa.array([c], pa.int32()), "n": pa.array([n], pa.int64()),
                                              "total": pa.array([_matrix(data, n).sum(axis=0).tolist()], pa.list_(pa.float64()))})


def _radii(pivots, batches):
    for batch in batches:
        for c, n, data in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
            far = np.sqrt(((_matrix(data, n) - pivots[c]) ** 2).sum(axis=1)).sum()
            yield pa.RecordBatch.from_pydict({"c": pa.array([c], pa.int32()), "total": pa.array([float(far)], pa.float64())})


def wanted_clusters(points: np.ndarray, own: int, pivots: dict, radii: dict) -> list[int]:
    """The own cluster and every other one that can be the nearest to some point."""
    others = [c for c in sorted(pivots) if c != own]
    if not others:
        return [own]
    away = np.stack([np.sqrt(((points - pivots[c]) ** 2).sum(axis=1)) for c in others], axis=1)
    radius = np.array([radii[c] for c in others])
    margin = 1e-9 * (1 + away + radius)  # rounding must not rule out a tie
    open_ones = np.abs(away - radius) - margin <= (away + radius + margin).min(axis=1, keepdims=True)
    return [own, *(c for c, yes in zip(others, open_ones.any(axis=0), strict=True) if yes)]


def _needs(pivots, radii, batches):
    for batch in batches:
        needs = [wanted_clusters(_matrix(data, n), c, pivots, radii)
                 for c, n, data in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(needs, type=pa.list_(pa.int32()))],
                                         names=["c", "tile", "n", "data", "needs"])


PARTS = "tile long, c int, n int, need int, sums binary"


def _distances(batches):
    """For two tiles: the sum of distances of each point of the first to those of the second."""
    for batch in batches:
        for tile, c, n, data, need, m, other in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            x, y = _matrix(data, n), _matrix(other, m)
            norms, sums = (y * y).sum(axis=1), np.empty(n)
            for at in range(0, n, BLOCK):
                part = x[at:at + BLOCK]
                squares = (part * part).sum(axis=1)[:, None] + norms - 2 * part @ y.T
                sums[at:at + BLOCK] = np.sqrt(np.maximum(squares, 0)).sum(axis=1)
            yield pa.RecordBatch.from_pydict(
                {"tile": pa.array([tile], pa.int64()), "c": pa.array([c], pa.int32()), "n": pa.array([n], pa.int32()),
                 "need": pa.array([need], pa.int32()), "sums": pa.array([sums.tobytes()], pa.binary())})


def silhouettes(own: int, sums: dict[int, np.ndarray], sizes: dict[int, int]) -> np.ndarray:
    """Silhouette of each point of a tile from its sums of distances by cluster."""
    inside = sums[own] / max(sizes[own] - 1, 1)
    others = [sums[c] / sizes[c] for c in sums if c != own]
    outside = np.min(others, axis=0) if others else np.zeros(len(inside))
    top = np.maximum(inside, outside)
    alone = (sizes[own] <= 1) | (top == 0)
    return np.where(alone, 0.0, (outside - inside) / np.where(alone, 1.0, top))


def _scores(sizes, batches):
    """Sum of silhouettes and number of points of each tile; its parts come one after another."""
    tile, own, held = None, None, {}

    def told():
        s = silhouettes(own, held, sizes)
        return pa.RecordBatch.from_pydict({"total": [float(s.sum())], "n": pa.array([len(s)], pa.int64())})

    for batch in batches:
        for t, c, _, need, sums in zip(*(col.to_pylist() for col in batch.columns), strict=True):
            if t != tile:
                if tile is not None:
                    yield told()
                tile, own, held = t, c, {}
            part = np.frombuffer(sums, dtype=np.float64)
            held[need] = held[need] + part if need in held else part
    if tile is not None:
        yield told()


def silhouette_euclidean(pred: DataFrame, features: str = "features", cluster: str = "cluster", tile: int = TILE) -> float:
    """M4: mean silhouette with plain Euclidean distance; 0 for fewer than two
    points. A point alone in its cluster has silhouette 0."""
    points = pred.select(vector_to_array(features).alias("x"), F.col(cluster).cast("int").alias("c"))
    tiles = materialize(points.mapInArrow(lambda batches: _tiles(tile, batches), TILES), "tiles")
    totals: dict[int, np.ndarray] = {}
    sizes: dict[int, int] = {}
    sums = tiles.mapInArrow(_sums, "c int, n long, total array<double>").select("c", "n", F.posexplode("total").alias("at", "v"))
    for r in sums.groupBy("c").agg(F.sum(F.when(F.col("at") == 0, F.col("n"))).alias("n")).collect():
        sizes[r.c] = r.n
    for r in sums.groupBy("c", "at").agg(F.sum("v").alias("v")).orderBy("c", "at").collect():
        totals.setdefault(r.c, []).append(r.v)
    if sum(sizes.values()) < 2:
        return 0.0
    pivots = {c: np.array(v) / sizes[c] for c, v in totals.items()}
    far = tiles.mapInArrow(lambda batches: _radii(pivots, batches), "c int, total double").groupBy("c").agg(F.sum("total").alias("total"))
    radii = {r.c: r.total / sizes[r.c] for r in far.collect()}
    numbers = tiles.select(F.col("c").alias("need"), F.col("tile").alias("other"))
    asked = tiles.mapInArrow(lambda batches: _needs(pivots, radii, batches), f"{TILES}, needs array<int>")
    asked = asked.select("tile", "c", "n", "data", F.explode("needs").alias("need")).join(F.broadcast(numbers), "need")
    right = tiles.select(F.col("tile").alias("other"), F.col("n").alias("m"), F.col("data").alias("against"))
    pairs = asked.join(right, "other").select("tile", "c", "n", "data", "need", "m", "against")
    parts = pairs.mapInArrow(_distances, PARTS).repartition("tile").sortWithinPartitions("tile", "need")
    scores = parts.mapInArrow(lambda batches: _scores(sizes, batches), "total double, n long").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n")).first()
    return float(scores.total / scores.n)
