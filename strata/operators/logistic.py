"""Weighted L2 logistic regressions of one table, fitted side by side.

Each model trains on the rows of some groups (all folds but one, all years before a
cutoff). A pass over the stored table adds up loss, gradient and curvature of every
model at its own place, so a Newton step of all models costs one scan. Nothing is held
in memory but a batch of rows and one sum per model and partition.

The objective is ``sum(weight * log loss) + |coefficients|^2 / 2`` (C = 1), over features
standardised by, and with balanced class weights of, the rows a model trains on. The
intercept is free. It is strictly convex; steps that do not lower it are halved.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.numeric import ordered_sum_of

#: A model is ready when a step promises less than this share of a row's loss.
TOLERANCE = 1e-12


@dataclass(frozen=True)
class Logistic:
    """``intercept`` and ``coefficients`` over ``(x - mean) / std`` (0 where std is 0)."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    stds: tuple[float, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        """Probability of label 1 from the feature columns."""
        margin = F.lit(self.intercept)
        for f, m, s, c in zip(self.features, self.means, self.stds, self.coefficients, strict=True):
            if s > 0 and c:
                margin = margin + (F.col(f"`{f}`") - F.lit(m)) / F.lit(s) * F.lit(c)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _design(batch, features, means, stds):
    x = np.ones((batch.num_rows, len(features) + 1))
    for j in range(len(features)):
        x[:, j + 1] = (batch.column(j).to_numpy(zero_copy_only=False) - means[j]) / stds[j]
    return x, batch.column(len(features)).to_numpy(zero_copy_only=False)


def _sums(features, means, stds, groups, uses, weights, places):
    """Loss, gradient and curvature of each model at its place, one row per model."""
    def summed(batches):
        size = len(features) + 1
        total = np.zeros((len(places), 1 + size + size * size))
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _design(batch, features, means, stds)
            group = np.searchsorted(groups, batch.column(len(features) + 1).to_numpy(zero_copy_only=False))
            margins = x @ places.T
            for k in range(len(places)):
                m = margins[:, k]
                weight = uses[k][group] * np.where(y > 0, weights[k][1], weights[k][0])
                small = np.exp(-np.abs(m))
                p = np.where(m >= 0, 1.0, small) / (1.0 + small)
                total[k, 0] += weight @ (np.log1p(small) + np.maximum(m, 0.0) - y * m)
                total[k, 1:size + 1] += x.T @ (weight * (p - y))
                total[k, size + 1:] += (x.T @ (x * (weight * p * (1.0 - p))[:, None])).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(places)), type=pa.int32()), pa.array(list(total))],
                                         names=["model", "sums"])
    return summed


def _moments(frame, features, means, stds, group):
    """Per (group, label): rows, and sums and squares of the scaled features."""
    scaled = [(F.col(f"`{f}`") - F.lit(m)) / F.lit(s) for f, m, s in zip(features, means, stds, strict=True)]
    aggs = [a for i, z in enumerate(scaled) for a in (F.sum(z).alias(f"s{i}"), F.sum(z * z).alias(f"q{i}"))]
    found = {}
    for r in frame.groupBy(F.col(group).alias("g"), F.col("label").cast("double").alias("y")).agg(
            F.count(F.lit(1)).alias("n"), *aggs).collect():
        if r.g is None or r.y not in (0.0, 1.0):
            raise ValueError(f"rows of group {r.g} with label {r.y}")
        found[r.g, r.y] = np.array([r.n, *(r[f"s{i}"] for i in range(len(scaled))), *(r[f"q{i}"] for i in range(len(scaled)))], float)
    return found


def fit(frame: DataFrame, features: list[str], group: str, trains: list, max_iter: int) -> list[Logistic]:
    """One model per entry of ``trains``, a set of values of ``group`` whose rows it
    trains on. ``frame`` (features, ``label`` 0 or 1, ``group``) is a stored table, scanned
    twice and once per step. A model that sees one class says that class, as its limit."""
    d, size = len(features), len(features) + 1
    row = frame.agg(*(a for i, f in enumerate(features) for a in (
        F.avg(f"`{f}`").alias(f"m{i}"), F.stddev_pop(f"`{f}`").alias(f"s{i}")))).first() if d else None
    means = [float(row[f"m{i}"] or 0.0) for i in range(d)]
    stds = [float(row[f"s{i}"] or 0.0) or 1.0 for i in range(d)]
    moments = _moments(frame, features, means, stds, group)
    groups = np.array(sorted({g for g, _ in moments}))
    uses = [np.array([float(g in set(t)) for g in groups.tolist()]) for t in trains]
    weights, turns, spread, fixed, rows = [], [], [], {}, []
    for k, t in enumerate(trains):
        of = {y: sum((v for (g, label), v in moments.items() if label == y and g in set(t)), np.zeros(1 + 2 * d)) for y in (0.0, 1.0)}
        n = of[0.0] + of[1.0]
        if not n[0]:
            raise ValueError("no rows to train on")
        if not of[0.0][0] or not of[1.0][0]:
            fixed[k] = np.inf if of[1.0][0] else -np.inf
        weights.append([n[0] / (2 * of[y][0]) if of[y][0] else 0.0 for y in (0.0, 1.0)])
        centre = n[1:size] / n[0]
        width = np.sqrt(np.maximum(n[size:] / n[0] - centre ** 2, 0.0))
        width[width < 1e-9] = 0.0
        # From (intercept, coefficients) of the model's own scaling to those of the table's.
        inverse = np.divide(1.0, width, out=np.zeros(d), where=width > 0)
        turn = np.diag(np.concatenate([[1.0], inverse]))
        turn[0, 1:] = -centre * inverse
        turns.append(turn), spread.append((centre, width)), rows.append(n[0])
    ridge = np.concatenate([[0.0], np.ones(d)])
    at = np.zeros((len(trains), size))
    value = np.full(len(trains), np.inf)
    tried, step = at.copy(), np.zeros_like(at)
    open_ = [k for k in range(len(trains)) if k not in fixed]
    table = frame.select(*(F.col(f"`{f}`").cast("double") for f in features), F.col("label").cast("double"), F.col(group))
    for _ in range(max_iter):
        if not open_:
            break
        places = np.array([turns[k] @ tried[k] for k in open_])
        sums = table.mapInArrow(_sums(features, means, stds, groups, [uses[k] for k in open_], [weights[k] for k in open_], places),
                                "model int, sums array<double>")
        sums = sums.select("model", F.posexplode("sums").alias("at", "v")).groupBy("model", "at").agg(
            ordered_sum_of(F.collect_list("v")).alias("v"))
        total = np.zeros((len(open_), 1 + size + size * size))
        for r in sums.collect():
            total[r["model"], r["at"]] = r["v"]
        left = []
        for i, k in enumerate(open_):
            f = total[i, 0] + tried[k] @ (ridge * tried[k]) / 2
            if f > value[k] + 1e-12 * abs(value[k]):
                step[k] /= 2
                if np.abs(step[k]).max() > 1e-12:
                    tried[k] = at[k] + step[k]
                    left.append(k)
                continue
            at[k], value[k] = tried[k], f
            slope = turns[k].T @ total[i, 1:size + 1] + ridge * at[k]
            curve = turns[k].T @ total[i, size + 1:].reshape(size, size) @ turns[k] + np.diag(ridge)
            curve[spread_zero(spread[k][1])] = 0.0
            curve[:, spread_zero(spread[k][1])] = 0.0
            curve += np.diag(spread_zero(spread[k][1]).astype(float))
            step[k] = -np.linalg.lstsq(curve, slope, rcond=None)[0]
            if -(slope @ step[k]) > TOLERANCE * rows[k]:
                tried[k] = at[k] + step[k]
                left.append(k)
        open_ = left
    found = []
    for k in range(len(trains)):
        centre, width = spread[k]
        found.append(Logistic(tuple(features), tuple((np.array(means) + centre * stds).tolist()), tuple((width * stds).tolist()),
                              tuple(at[k, 1:].tolist()), float(fixed.get(k, at[k, 0]))))
    return found


def spread_zero(width: np.ndarray) -> np.ndarray:
    """Places of features that do not vary, intercept first: their coefficients stay 0."""
    return np.concatenate([[False], width == 0])
