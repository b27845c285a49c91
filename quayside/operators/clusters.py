"""K-means for many numbers of clusters at once: every pass over the rows serves all of them.

A pass multiplies the rows by the centres of all runs that still move, and adds up, per run and centre, the rows that
are nearest to it, their number, their squares and their squared distances. The new centres, the inertia and, with one
pass more, the silhouettes come from these sums.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, functions as F

from quayside.plans.sums import keyed_sums, matrix

AT_ONCE = 1 << 21  # distances worked out at once
SAMPLE = 50  # rows per centre that the first centres are drawn from, at most


def point_rows(df: DataFrame, features: str) -> DataFrame:
    """The column, a vector or an array, as arrays ``x``; rows without one take no part. Cache it: each pass reads it."""
    whole = df.filter(F.col(features).isNotNull())
    is_vector = isinstance(df.schema[features].dataType, VectorUDT)
    return whole.select((vector_to_array(features) if is_vector else F.col(features).cast("array<double>")).alias("x"))


def _chunks(batch: pa.RecordBatch, width: int, columns: int):
    x = matrix(batch.column(0), width)
    step = max(1, AT_ONCE // max(1, columns))
    return (x[i:i + step] for i in range(0, len(x), step))


def cluster_sums(rows: DataFrame, centres: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Per run the sums (centre, …): coordinates of the nearest rows, their number, squares and squared distances.

    The lowest centre wins a tie.
    """
    runs = list(centres)
    every = np.concatenate([centres[r] for r in runs])
    width, squares = every.shape[1], (every * every).sum(axis=1)
    cuts = np.cumsum([0, *[len(centres[r]) for r in runs]])

    def arrays(batch: pa.RecordBatch):
        for x in _chunks(batch, width, len(every)):
            own = (x * x).sum(axis=1)
            away = squares[None, :] - 2.0 * x @ every.T
            for run, lo, hi in zip(runs, cuts, cuts[1:]):
                nearest = np.argmin(away[:, lo:hi], axis=1)
                least = np.maximum(own + away[np.arange(len(x)), lo + nearest], 0.0)
                member = np.zeros((hi - lo, len(x)))
                member[nearest, np.arange(len(x))] = 1.0
                yield run, member @ np.column_stack([x, np.ones(len(x)), own, least])

    return {run: v.reshape(-1, width + 3) for run, v in keyed_sums(rows, arrays).items()}


def silhouettes(rows: DataFrame, centres: dict[int, np.ndarray], sums: dict[int, np.ndarray]) -> dict[int, float]:
    """Per run the mean silhouette on squared distances; a row that is alone in its cluster counts 0.

    The mean squared distance of a row from a cluster's rows follows from the cluster's sums. NaN for one cluster.
    """
    width = next(iter(sums.values())).shape[1] - 3
    there = {run: v[:, width] > 0 for run, v in sums.items()}  # clusters with rows
    runs = [run for run in sums if there[run].sum() > 1]

    def arrays(batch: pa.RecordBatch):
        for x in _chunks(batch, width, sum(len(centres[r]) for r in runs)):
            own = (x * x).sum(axis=1)
            at = np.arange(len(x))
            for run in runs:
                c, kept = centres[run], there[run]
                mine = np.argmin((c * c).sum(axis=1)[None, :] - 2.0 * x @ c.T, axis=1)
                mine = (np.cumsum(kept) - 1)[mine]
                total, n, square = sums[run][kept, :width], sums[run][kept, width], sums[run][kept, width + 1]
                mean = np.maximum(own[:, None] + square / n - 2.0 * x @ (total / n[:, None]).T, 0.0)
                inside = mean[at, mine] * n[mine] / np.maximum(n[mine] - 1, 1)
                mean[at, mine] = np.inf
                outside = mean.min(axis=1)
                larger = np.maximum(inside, outside)
                s = np.where((n[mine] > 1) & (larger > 0), (outside - inside) / np.where(larger > 0, larger, 1.0), 0.0)
                yield run, np.array([s.sum(), len(x)])

    found = keyed_sums(rows, arrays) if runs else {}
    return {run: float(found[run][0] / found[run][1]) if run in found else float("nan") for run in sums}


def first_centres(rows: DataFrame, ks: list[int], seed: int) -> dict[int, np.ndarray]:
    """For each k the first k points of one k-means++ sequence over at most SAMPLE * max(ks) different rows, which a
    hash of their values picks. Fewer than k where there are fewer different rows."""
    wanted, total = SAMPLE * max(ks), rows.count()
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("x")), F.lit(1_000_000))
    some = rows.withColumn("draw", draw).filter(F.col("draw") < max(1, -(-4_000_000 * wanted // max(1, total))))
    sample = some.distinct().orderBy("draw", "x").limit(wanted).select("x").toArrow().column("x").to_pylist()
    if not sample:
        return {}
    points, rng = np.array(sample, float), np.random.default_rng(seed)
    order = [int(rng.integers(len(points)))]
    near = ((points - points[order[0]]) ** 2).sum(axis=1)
    while len(order) < max(ks) and near.sum() > 0:
        order.append(int(rng.choice(len(points), p=near / near.sum())))
        near = np.minimum(near, ((points - points[order[-1]]) ** 2).sum(axis=1))
    return {k: points[order[:k]] for k in ks}


def fit_many_kmeans(rows: DataFrame, centres: dict[int, np.ndarray], max_iter: int = 20, tol: float = 1e-4
                    ) -> dict[int, np.ndarray]:
    """The centres after at most ``max_iter`` passes; a run ends when none of its centres moves further than ``tol``.

    A centre that no row is nearest to stays where it is.
    """
    centres, left = dict(centres), list(centres)
    for _ in range(max_iter):
        if not left:
            break
        for run, v in cluster_sums(rows, {r: centres[r] for r in left}).items():
            n = v[:, -3]
            moved = np.where(n[:, None] > 0, v[:, :-3] / np.maximum(n, 1)[:, None], centres[run])
            if ((moved - centres[run]) ** 2).sum(axis=1).max() <= tol * tol:
                left.remove(run)
            centres[run] = moved
    return centres


def judge_centres(rows: DataFrame, centres: dict[int, np.ndarray]) -> list[tuple[int, float, float]]:
    """(run, inertia, silhouette) of given centres, in two passes for all runs."""
    sums = cluster_sums(rows, centres) if centres else {}
    found = silhouettes(rows, centres, sums) if sums else {}
    return [(run, float(sums[run][:, -1].sum()), found[run]) for run in sorted(sums)]
