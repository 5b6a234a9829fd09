"""Decision trees over cells of equal rows, each grown whole inside a task.

A tree needs the cells only: features as codes, with the number of rows of each class.
They are sent to the tasks once, every task grows its trees level by level from counts of
(node, value, class), and gives back a row of nodes a tree: no job and no shuffle a tree.
Trees and blocks of them have the attributes of Spark's tree models that are used here.

Trees are those of the usual forest: a bootstrap of their own (a cell of ``n`` rows is drawn a
Poisson(n) number of times), ``ceil(sqrt(features))`` features tried at every node, Gini
impurity of the class weights, all cuts between different values, no pruning.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import DenseVector, Vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_GAIN = 2.0**-52
TASKS_PER_CORE = 3
#: Of all nodes of a tree; ``stats`` are the class weights of one after the other.
NODES = {"stats": "double", "gain": "double", "feature": "int", "threshold": "double", "left": "int", "right": "int"}


@dataclass(frozen=True)
class Cells:
    """``codes[i, f]`` is the place of cell ``i``'s value among ``values[f]``, in order; the cell
    has ``n[k, i]`` rows of class ``k``, which weigh ``weights[k]`` each."""

    codes: np.ndarray
    values: tuple[np.ndarray, ...]
    n: np.ndarray
    weights: np.ndarray


def collected(train: DataFrame, features: list[str], classes: int) -> Cells:
    """``train`` (``features``, ``label_idx``, ``weight`` of a row, ``n``), in the order of
    the features: a run over the same cells draws the same bootstraps."""
    table = train.select(*(F.col(f"`{f}`").cast("double").alias(f"f{i}") for i, f in enumerate(features)),
                         F.col("label_idx").cast("int").alias("label"), "weight", "n").toArrow()
    label, weight = (table.column(name).to_numpy() for name in ("label", "weight"))
    weights = np.zeros(classes)
    weights[label] = weight
    if (weights[label] != weight).any():
        raise ValueError("rows of one class have different weights")
    values, codes, key, size = [], [], np.zeros(len(label), np.int64), 1
    for i in range(len(features)):
        found, code = np.unique(table.column(f"f{i}").to_numpy(), return_inverse=True)
        if size * len(found) >= 2**62:
            key = np.unique(key, return_inverse=True)[1]
            size = len(key)
        key, size = key * len(found) + code, size * len(found)
        values.append(found)
        codes.append(code.astype(np.min_scalar_type(len(found))))
    _, first, cell = np.unique(key, return_index=True, return_inverse=True)
    n = np.bincount(label * len(first) + cell, table.column("n").to_numpy(), classes * len(first))
    codes = np.ascontiguousarray(np.stack([code[first] for code in codes], axis=1))
    return Cells(codes, tuple(values), n.reshape(classes, len(first)).astype(np.int64), weights)


def _best_cuts(codes, node, drawn, tried, counts, weights, sizes):
    """Each node tries the feature ``tried[node]``: the largest sum of squared class weights
    over weight, added up over both sides, and the last code on the left."""
    ends = np.cumsum(sizes[tried])
    bins, size = ends - sizes[tried], int(ends[-1])
    key = bins[node] + codes.ravel()[np.arange(0, codes.size, codes.shape[1]) + tried[node]]
    at = None
    if size > 4 * len(key) + 65_536:
        at, key = np.unique(key, return_inverse=True)
        size = len(at)
    sums = np.stack([np.bincount(key, of, size) for of in drawn], axis=1)
    if at is None:
        at = np.flatnonzero(sums.any(axis=1))
        sums = sums[at]
    owner = np.searchsorted(ends, at, side="right")
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    left = sums.cumsum(axis=0)
    left -= (left - sums)[starts][owner]  # numbers of rows: exact
    right = (counts[owner] - left) * weights
    left *= weights
    least, rest = left.sum(axis=1), right.sum(axis=1)
    score = (left * left).sum(axis=1) / least + (right * right).sum(axis=1) / np.where(rest > 0, rest, 1.0)
    score[rest <= 0] = -np.inf  # the last value has nothing on its right
    best = np.maximum.reduceat(score, starts)
    places = np.flatnonzero(score == best[owner])
    places = places[np.unique(owner[places], return_index=True)[1]]
    return best, at[places] - bins


def grow(cells: Cells, draws: np.ndarray, depth: int, tries: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One tree over the cells, drawn ``draws[k, i]`` times each: its nodes, parents first.
    ``left`` and ``right`` are -1 at leaves."""
    rows = np.flatnonzero(draws.any(axis=0))
    codes, drawn = cells.codes[rows], draws[:, rows].astype(float)
    sizes = np.array([len(v) for v in cells.values])
    node, nodes, first, levels = np.zeros(len(rows), np.int64), 1, 0, []
    for level in range(depth + 1):
        counts = np.stack([np.bincount(node, of, nodes) for of in drawn], axis=1)
        stats = counts * cells.weights
        total = stats.sum(axis=1)
        squares = ((stats / total[:, None])**2).sum(axis=1)
        gain, feature, cut = np.full(nodes, LEAST_GAIN), np.full(nodes, -1), np.full(nodes, -1)
        mixed = (counts > 0).sum(axis=1) > 1
        if level < depth and mixed.any():
            for tried in rng.random((nodes, len(sizes))).argsort(axis=1).T[:tries]:  # the first of equal gains wins
                best, code = _best_cuts(codes, node, drawn, tried, counts, cells.weights, sizes)
                found = best / total - squares
                better = mixed & (found > gain)
                gain[better], feature[better], cut[better] = found[better], tried[better], code[better]
        split = feature >= 0
        child = first + nodes + 2 * (np.cumsum(split) - 1)
        threshold = np.zeros(nodes)
        for i in np.flatnonzero(split):
            low, high = cells.values[feature[i]][cut[i]:cut[i] + 2]
            middle = low / 2 + high / 2
            threshold[i] = middle if middle < high else low  # also where the next value is NaN
        levels.append({
            "stats": stats, "gain": np.where(split, gain, -1.0), "feature": feature, "threshold": threshold,
            "left": np.where(split, child, -1), "right": np.where(split, child + 1, -1)})
        if not split.any():
            break
        stay = split[node]
        if not stay.all():
            codes, drawn, node = codes[stay], drawn[:, stay], node[stay]
        side = codes[np.arange(len(node)), feature[node]] > cut[node]
        node = child[node] - first - nodes + side
        first, nodes = first + nodes, 2 * int(split.sum())
    return {name: np.concatenate([part[name] for part in levels]) for name in levels[0]}


def bootstrap(n: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """How often rows of each class and cell are drawn of ``n``; never no row at all."""
    draws = rng.poisson(n)
    while not draws.any():
        draws = rng.poisson(n)
    return draws


@dataclass(frozen=True)
class Tree:
    """Nodes of one tree, parents first; ``feature``, ``left`` and ``right`` are -1 at leaves."""

    nodes: dict[str, np.ndarray]
    features: int

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Gain by weight of the nodes a feature splits, adding up to 1."""
        inner = self.nodes["feature"] >= 0
        gains = self.nodes["gain"][inner] * self.nodes["stats"][inner].sum(axis=1)
        found = np.bincount(self.nodes["feature"][inner], gains, self.features)
        return DenseVector(found / (found.sum() or 1.0))

    def predictProbability(self, row: Vector) -> DenseVector:  # noqa: N802
        at = 0
        while self.nodes["feature"][at] >= 0:
            side = "left" if row[int(self.nodes["feature"][at])] <= self.nodes["threshold"][at] else "right"
            at = self.nodes[side][at]
        return DenseVector(self.nodes["stats"][at] / self.nodes["stats"][at].sum())


@dataclass(frozen=True)
class Block:
    """Trees that vote together."""

    trees: tuple[Tree, ...]

    @property
    def getNumTrees(self) -> int:  # noqa: N802
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802
        """Mean over the trees, adding up to 1."""
        found = np.sum([tree.featureImportances.toArray() for tree in self.trees], axis=0)
        return DenseVector(found / (found.sum() or 1.0))


def probabilities(spark: SparkSession, blocks: tuple[Block, ...], features: Column) -> Column:
    """Mean class probabilities over all trees of ``blocks``; ``features`` is an array."""
    each = [tree.nodes for block in blocks for tree in block.trees]
    roots = np.cumsum([0, *(len(nodes["feature"]) for nodes in each)])
    whole = {name: np.concatenate([nodes[name] for nodes in each]) for name in NODES}
    own, leaf = np.repeat(roots[:-1], np.diff(roots)), whole["feature"] < 0
    here = np.arange(roots[-1])
    # A leaf leads to itself.
    left, right = (np.where(leaf, here, whole[side] + own) for side in ("left", "right"))
    shares = whole["stats"] / whole["stats"].sum(axis=1, keepdims=True)
    sent = spark.sparkContext.broadcast((np.maximum(whole["feature"], 0), whole["threshold"], left, right, leaf, shares, roots[:-1]))

    @F.arrow_udf("array<double>")
    def scored(rows: pa.Array) -> pa.Array:
        feature, threshold, left, right, leaf, shares, roots = sent.value
        x = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        total, place = np.zeros((len(rows), shares.shape[1])), np.arange(len(rows))
        for root in roots if len(rows) else ():
            at = np.full(len(rows), root)
            while not leaf[at].all():
                at = np.where(x[place, feature[at]] <= threshold[at], left[at], right[at])
            total += shares[at]
        ends = np.arange(len(rows) + 1, dtype=np.int32) * shares.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array((total / len(roots)).ravel()))

    return scored(features)


def _growing(cells, depth: int, tries: int, seed: int):
    def grown(batches):
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                rng = np.random.default_rng([seed & (2**63 - 1), tree])
                nodes = grow(cells.value, bootstrap(cells.value.n, rng), depth, tries, rng)
                lists = [pa.ListArray.from_arrays(pa.array([0, nodes[name].size], pa.int32()), pa.array(
                    nodes[name].ravel().astype(np.int32 if kind == "int" else float))) for name, kind in NODES.items()]
                yield pa.RecordBatch.from_arrays([pa.array([tree]), *lists], names=["tree", *NODES])
    return grown


def forest_of(train: DataFrame, features: list[str], classes: int, trees: int, depth: int, seed: int) -> list[Tree]:
    """``trees`` trees over the cells of ``train`` (see :func:`collected`)."""
    spark = train.sparkSession
    cells = spark.sparkContext.broadcast(collected(train, features, classes))
    tasks = min(trees, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    schema = ", ".join(["tree bigint", *(f"{name} array<{kind}>" for name, kind in NODES.items())])
    try:
        grown = spark.range(0, trees, 1, tasks).mapInArrow(
            _growing(cells, depth, math.ceil(math.sqrt(len(features))), seed), schema).toArrow().sort_by("tree")
    finally:
        cells.destroy()
    found = []
    for row in range(trees):
        nodes = {name: grown.column(name)[row].values.to_numpy(zero_copy_only=False) for name in NODES}
        found.append(Tree(nodes | {"stats": nodes["stats"].reshape(-1, classes)}, len(features)))
    return found
