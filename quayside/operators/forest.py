"""Random forests whose trees all grow in the same passes over the rows.

Features are cut into at most 256 bins each: by value where a feature has no more values, else at quantiles of all rows.
The big nodes of all trees are split level by level, by a job each: every task counts its rows by node, feature and bin,
and the driver gets the sums, sized by the nodes. As soon as a node has at most ``IN_ONE`` rows, they are brought
together, as bins, and its subtree is grown in one go, thousands of rows and all nodes of a level at once. So a forest
takes some jobs, not some per tree and level, and no task holds more than the rows of such a node.

As in Spark ML, a split is the one with the largest fall of the Gini impurity among a random subset of the features, a node
without a fall is a leaf, and leaves of the same class below one node are merged into it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, functions as F

from quayside.plans.sums import keyed_sums, matrix
from quayside.sources import spread

BINS = 256
IN_ONE = 250_000  # rows of a node whose subtree is grown in one task
LEAST_FALL = 1e-9  # of the impurity; less is the error of sums
MAX_CLASSES = 100


# --- one tree ------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Tree:
    """Nodes by rising ``id`` (the root is 1, below i are 2i and 2i+1): places of the children (-1 in a leaf), feature,
    threshold, weights per class, fall of the impurity."""

    number: int
    id: np.ndarray
    left: np.ndarray
    right: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    weights: np.ndarray
    fall: np.ndarray

    @property
    def shares(self) -> np.ndarray:
        return self.weights / self.weights.sum(axis=1, keepdims=True)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The place of the leaf of each row."""
        at = np.zeros(len(x), np.int64)
        rows = np.flatnonzero(self.left[at] >= 0)
        while len(rows):
            node = at[rows]
            at[rows] = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            rows = rows[self.left[at[rows]] >= 0]
        return at

    def getProbabilityCol(self) -> str:
        return f"tree_{self.number}"

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the shares of the classes in the leaf of each row, a vector."""
        found = _shares_of([self])
        return df.withColumn(self.getProbabilityCol(), array_to_vector(found(vector_to_array("features"))))


@dataclass(frozen=True)
class Forest:
    """The trees; transforms rows with ``features`` as a forest of Spark ML does."""

    trees: list
    numFeatures: int

    @property
    def totalNumNodes(self) -> int:
        return sum(len(t.id) for t in self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        """Falls of the impurity by feature, weighted by the nodes, normalised per tree and over the forest."""
        total = np.zeros(self.numFeatures)
        for t in self.trees:
            inner = t.left >= 0
            each = np.bincount(t.feature[inner], (t.fall * t.weights.sum(axis=1))[inner], self.numFeatures)
            total += each / each.sum() if each.sum() > 0 else 0.0
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def transform(self, df: DataFrame) -> DataFrame:
        found = df.withColumn("_shares", _shares_of(self.trees)(vector_to_array("features")))
        best = F.array_position("_shares", F.array_max("_shares")) - 1
        return found.withColumns({"probability": array_to_vector("_shares"),
                                  "prediction": best.cast("double")}).drop("_shares")


def _shares_of(trees: list):
    """Mean shares of the classes over the trees, an array, of an array of features."""
    shares = [t.shares for t in trees]

    @F.pandas_udf("array<double>")
    def found(features: pd.Series) -> pd.Series:
        if not len(features):
            return pd.Series([], dtype=object)
        x = np.stack(features.to_numpy()).astype(float)
        return pd.Series(list(sum(s[t.leaves(x)] for t, s in zip(trees, shares)) / len(trees)))

    return found


def _tree(number: int, parts: list[dict], width: int) -> Tree:
    """A tree of nodes that were found in parts, with leaves of one class below a node merged into it."""
    n = {k: np.concatenate([p[k] for p in parts]) for k in ("id", "feature", "threshold", "fall")}
    n["weights"] = np.concatenate([p["weights"].reshape(-1, width) for p in parts])
    order = np.argsort(n["id"])
    n = _pruned({k: v[order] for k, v in n.items()})
    inner = n["feature"] >= 0
    left = np.where(inner, np.searchsorted(n["id"], 2 * n["id"]), -1)
    return Tree(number, n["id"], left, np.where(inner, left + 1, -1), n["feature"].astype(np.int64), n["threshold"],
                n["weights"], n["fall"])


def _pruned(n: dict) -> dict:
    """Without pairs of leaves of the same class, from the lowest level up; nodes by rising id."""
    ids, feature, kind = n["id"], n["feature"].copy(), n["weights"].argmax(axis=1)
    level, kept = np.frexp(ids.astype(float))[1], np.ones(len(ids), bool)
    for deep in range(level.max(initial=0) - 1, 0, -1):
        up = np.flatnonzero((level == deep) & (feature >= 0))
        left = np.searchsorted(ids, 2 * ids[up])
        # In a part of a tree a child may be the root of another part, which is not there yet.
        here = np.minimum(left + 1, len(ids) - 1)
        both = (ids[here] == 2 * ids[up] + 1) & (ids[np.minimum(left, len(ids) - 1)] == 2 * ids[up])
        up, left = up[both], left[both]
        same = (feature[left] < 0) & (feature[left + 1] < 0) & (kind[left] == kind[left + 1])
        feature[up[same]] = -1
        kept[left[same]] = kept[left[same] + 1] = False
    out = {**n, "feature": feature}
    return {k: v[kept] for k, v in out.items()}


# --- splits --------------------------------------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64: 64 random-looking bits."""
    z = values.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _subsets(seed: int, ids: np.ndarray, width: int, k: int) -> np.ndarray:
    """k different features for each node, by a hash of the seed and the node."""
    if k >= width:
        return np.tile(np.arange(width), (len(ids), 1))
    base = _mixed(_mixed(np.array([seed], np.int64).view(np.uint64)) ^ ids.astype(np.uint64))
    draws = _mixed(base[:, None] ^ _mixed(np.arange(1, width + 1, dtype=np.uint64))[None, :])
    return np.argsort(draws, axis=1)[:, :k]


def _gini(weights: np.ndarray) -> np.ndarray:
    total = weights.sum(axis=-1)
    return 1.0 - ((weights / np.where(total > 0, total, 1.0)[..., None]) ** 2).sum(axis=-1)


def _falls(node: np.ndarray, bins: np.ndarray, weights: np.ndarray, totals: np.ndarray):
    """The best split of each node on one feature: its fall, the last bin to the left and the first to the right.

    ``weights`` (a row per entry, a column per class) are added up by node and bin; ``totals`` are the nodes'.
    """
    key = node * BINS + bins
    order = np.argsort(key, kind="stable")
    key, node = key[order], node[order]
    upto = np.cumsum(weights[order], axis=0)
    last = np.flatnonzero(np.append(key[1:] != key[:-1], True))  # of each (node, bin)
    of, at, upto = node[last], key[last] % BINS, upto[last]
    first = np.append(True, of[1:] != of[:-1])
    begin = np.maximum.accumulate(np.where(first, np.arange(len(of)), 0))
    before = np.concatenate([np.zeros((1, weights.shape[1])), upto[:-1]])[begin]
    left = upto - before
    right = np.maximum(totals[of] - left, 0.0)
    fall, low, high = np.full(len(totals), -1.0), np.zeros(len(totals), int), np.zeros(len(totals), int)
    split = np.flatnonzero(~np.append(first[1:], True))  # not after the last bin of a node
    if len(split):
        parent = of[split]
        n, l, r = totals[parent].sum(axis=1), left[split].sum(axis=1), right[split].sum(axis=1)
        value = np.round(_gini(totals)[parent] - (l * _gini(left[split]) + r * _gini(right[split])) / n, 10)
        order = np.lexsort((split, -value, parent))
        best = order[np.append(True, parent[order][1:] != parent[order][:-1])]
        fall[parent[best]], low[parent[best]], high[parent[best]] = value[best], at[split[best]], at[split[best] + 1]
    return fall, low, high


@dataclass(frozen=True)
class Cuts:
    """The least and the largest value that a bin of a feature may have: one for a feature that is binned by value."""

    upper: list
    lower: list

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(u[:-1], x[:, f], "left") for f, u in enumerate(self.upper)]).astype(np.uint8)

    def thresholds(self, feature: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Between the bins ``low`` and ``high``."""
        out = np.zeros(len(feature))
        for f in np.unique(feature):
            here = feature == f
            a, b = self.upper[f][low[here]], self.lower[f][high[here]]
            middle = a + (b - a) / 2
            out[here] = np.where((middle >= a) & (middle < b), middle, a)
        return out


def _choose(pick: Callable, totals: np.ndarray, features: np.ndarray, cuts: Cuts):
    """(feature or -1, last left bin, threshold, fall) of the best split of each node; ``pick(j)`` are the entries of the
    j-th feature of the nodes."""
    fall, low, high = np.full(len(totals), -1.0), np.zeros(len(totals), int), np.zeros(len(totals), int)
    feature = np.full(len(totals), -1)
    for j in range(features.shape[1]):
        f, a, b = _falls(*pick(j), totals)
        better = (f > fall) & (f > LEAST_FALL)
        fall[better], low[better], high[better], feature[better] = f[better], a[better], b[better], features[better, j]
    threshold = np.zeros(len(totals))
    split = feature >= 0
    threshold[split] = cuts.thresholds(feature[split], low[split], high[split])
    return feature, low, threshold, np.maximum(fall, 0.0)


def _subtree(x: np.ndarray, y: np.ndarray, w: np.ndarray, root: int, seed: int, max_depth: int, k: int, classes: int,
             cuts: Cuts) -> dict:
    """All nodes from ``root`` down, level by level."""
    each = np.zeros((len(y), classes))
    each[np.arange(len(y)), y] = w
    ids, at, found = np.array([root], np.int64), np.zeros(len(y), np.int64), []
    while len(ids):
        totals = np.column_stack([np.bincount(at, each[:, c], len(ids)) for c in range(classes)])
        features = _subsets(seed, ids, x.shape[1], k)
        open_ = (np.count_nonzero(totals, axis=1) > 1) & (ids < 2 ** max_depth)
        some = np.flatnonzero(open_[at])
        place = np.cumsum(open_) - 1
        node, xs, ws = place[at[some]], x[some], each[some]
        feature, low = np.full(len(ids), -1), np.zeros(len(ids), int)
        threshold, fall = np.zeros(len(ids)), np.zeros(len(ids))
        if len(some):
            chosen = features[open_]
            feature[open_], low[open_], threshold[open_], fall[open_] = _choose(
                lambda j: (node, xs[np.arange(len(xs)), chosen[node, j]].astype(np.int64), ws), totals[open_], chosen, cuts)
        found.append({"id": ids, "feature": feature, "threshold": threshold, "weights": totals, "fall": fall})
        inner = feature >= 0
        rows = np.flatnonzero(inner[at])
        node = at[rows]
        down = x[rows, feature[node]] > low[node]
        at = 2 * (np.cumsum(inner) - 1)[node] + down
        x, y, each = x[rows], y[rows], each[rows]
        ids = (2 * ids[inner][:, None] + np.arange(2)[None, :]).ravel()
    return _pruned({key: np.concatenate([p[key] for p in found]) for key in found[0]})


# --- the forest ----------------------------------------------------------------------------------------


def find_cuts(rows: DataFrame, width: int) -> Cuts:
    """The bins of each feature (an array column ``x``): its values if there are at most BINS, else between quantiles."""
    def values(batches):
        seen, many = [np.zeros(0)] * width, [False] * width
        for b in batches:
            x = matrix(b.column(0), width)
            for f in range(width):
                if not many[f]:
                    seen[f] = np.union1d(seen[f], x[:, f])
                    many[f] = len(seen[f]) > BINS
        yield pa.RecordBatch.from_arrays([
            pa.array(range(width), pa.int32()),
            pa.array([None if m else s for m, s in zip(many, seen)], pa.list_(pa.float64()))], names=["f", "v"])

    found = (rows.select("x").mapInArrow(values, "f int, v array<double>")
             .select("f", F.explode_outer(F.coalesce("v", F.array(F.lit(None).cast("double")))).alias("v"),
                     F.col("v").isNull().alias("many"))
             .groupBy("f").agg(F.max("many").alias("many"), F.collect_set("v").alias("v"))
             .select("f", F.when(~F.col("many") & (F.size("v") <= BINS), F.col("v")).alias("v")).collect())
    upper: list = [None] * width
    lower: list = [None] * width
    for r in found:
        if r.v is not None:
            upper[r.f] = lower[r.f] = np.sort(np.array(r.v, float))
    wide = [f for f in range(width) if upper[f] is None]
    if wide:
        probs = [i / BINS for i in range(1, BINS)]
        row = rows.agg(*[F.percentile_approx(F.col("x")[f], probs, 100_000).alias(f"q{f}") for f in wide],
                       *[F.min(F.col("x")[f]).alias(f"a{f}") for f in wide],
                       *[F.max(F.col("x")[f]).alias(f"b{f}") for f in wide]).first()
        for f in wide:
            upper[f] = np.unique(np.array([*row[f"q{f}"], row[f"b{f}"]], float))
            lower[f] = np.concatenate([[row[f"a{f}"]], upper[f][:-1]])
    return Cuts(upper, lower)


def grow_forest(rows: DataFrame, label: str, weight: str | None, numbers: list[int], seed: int, max_depth: int, k: int | None,
                bags: Callable[[pa.RecordBatch], np.ndarray], also: list[str]) -> list[Tree]:
    """The trees of the given numbers on rows with ``features``.

    ``k`` features are looked at for a split, by default the square root of their number. ``bags`` gives how often each row of a batch is in each tree's sample, from the columns ``also``. The label is a class
    number from 0. An empty sample is an error.
    """
    one = rows.select("features").first()
    if one is None or not one.features.size:
        raise ValueError("a forest needs rows and features")
    width = one.features.size
    k = k or max(1, math.ceil(math.sqrt(width)))
    most = rows.agg(F.max(label).alias("m"), F.min(label).alias("l"),
                    F.bool_and(F.col(label) == F.floor(label)).alias("whole"), F.count_if(F.col(label).isNull()).alias("no")).first()
    if most.no or not most.whole or most.l < 0 or most.m >= MAX_CLASSES:
        raise ValueError(f"labels are whole numbers from 0 to {MAX_CLASSES - 1}")
    classes = max(2, int(most.m) + 1)
    plain = rows.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"),
                        (F.lit(1.0) if weight is None else F.col(weight).cast("double")).alias("w"), *also)
    cuts = find_cuts(plain, width)

    def blocks(batches):
        for b in batches:
            if b.num_rows:
                bag = np.ascontiguousarray(bags(b).astype(np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in (
                    cuts.bins(matrix(b.column(0), width)).tobytes(),
                    b.column(1).to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                    b.column(2).to_numpy(zero_copy_only=False).tobytes(), bag.tobytes())], names=["x", "y", "w", "bag"])

    def read(batch) -> Iterator[tuple]:
        for x, y, w, bag in zip(*[c.to_pylist() for c in batch.columns]):
            y = np.frombuffer(y, np.uint8)
            yield (np.frombuffer(x, np.uint8).reshape(-1, width), y, np.frombuffer(w, float),
                   np.frombuffer(bag, np.uint8).reshape(len(y), -1))

    #: Nodes found so far by (tree, id), with the split as bins; those still open by (tree, id), with their rows.
    done: dict[tuple[int, int], dict] = {}

    def sent(x, rows, t):
        """The ids of the nodes where rows are in what is known of a tree."""
        at = np.ones(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left):
            for i in np.unique(at[left]):
                here = left[at[left] == i]
                split = done.get((t, int(i)))
                if split is None or split["feature"] < 0:
                    left = left[at[left] != i]
                else:
                    at[here] = 2 * i + (x[rows[here], split["feature"]] > split["low"])
        return at

    def parts(batch):
        """Each block's rows of each tree and open node: place of the tree, node, rows."""
        for x, y, w, bag in read(batch):
            for place, t in enumerate(numbers):
                rows = np.flatnonzero((bag[:, place] > 0) & (w > 0))
                if len(rows):
                    at = sent(x, rows, t) if (t, 1) in done else np.ones(len(rows), np.int64)
                    for i in np.unique(at):
                        some = rows[at == i]
                        if (t, int(i)) not in done:
                            yield place, int(i), x[some], y[some], bag[some, place] * w[some]

    held = spread(plain).mapInArrow(blocks, "x binary, y binary, w binary, bag binary").cache()
    try:
        def sizes(batch):
            total = np.zeros(len(numbers))
            for _x, _y, w, bag in read(batch):
                total += np.count_nonzero((bag > 0) & (w > 0)[:, None], axis=0)
            yield 0, total

        n = keyed_sums(held, sizes)[0].astype(int)
        if not n.all():
            raise ValueError("the sample of a tree is empty")
        frontier = {(t, 1): int(c) for t, c in zip(numbers, n)}
        while big := sorted(key for key, c in frontier.items() if c > IN_ONE):
            index = {key: i for i, key in enumerate(big)}
            subset = {key: _subsets(seed + key[0], np.array([key[1]]), width, k)[0] for key in big}

            def counts(batch):
                # The last class counts rows, whatever their weight.
                for place, i, x, y, w in parts(batch):
                    key = (numbers[place], i)
                    if key in index:
                        cells = [np.bincount((j * BINS + x[:, f].astype(np.int64)) * (classes + 1) + c, v,
                                             k * BINS * (classes + 1))
                                 for j, f in enumerate(subset[key]) for c, v in ((y.astype(np.int64), w), (classes, np.ones(len(y))))]
                        yield index[key], sum(cells)

            for i, cells in keyed_sums(held, counts).items():
                key = big[i]
                del frontier[key]
                t, at = key
                table = cells.reshape(k, BINS, classes + 1)
                totals = table[0, :, :classes].sum(axis=0)[None, :]
                place = lambda j: (lambda b: (np.zeros(len(b), np.int64), b, table[j, b, :classes]))(
                    np.flatnonzero(table[j, :, classes]))
                feature, low, threshold, fall = np.array([-1]), np.array([0]), np.zeros(1), np.zeros(1)
                if np.count_nonzero(totals) > 1 and at < 2 ** max_depth:
                    feature, low, threshold, fall = _choose(place, totals, subset[key][None, :], cuts)
                done[key] = {"id": np.array([at]), "feature": feature, "threshold": threshold, "weights": totals,
                             "fall": fall, "low": int(low[0])}
                if feature[0] >= 0:
                    rows_of = table[list(subset[key]).index(feature[0]), :, classes]
                    under = int(rows_of[:low[0] + 1].sum())
                    frontier[(t, 2 * at)], frontier[(t, 2 * at + 1)] = under, int(rows_of.sum()) - under
        found = _small(held, parts, sorted(frontier), numbers, width, classes, seed, max_depth, k, cuts)
    finally:
        held.unpersist()
    by_tree: dict[int, list] = {t: [] for t in numbers}
    for (t, _i), node in done.items():
        by_tree[t].append(node)
    for t, node in found:
        by_tree[t].append(node)
    return [_tree(t, by_tree[t], classes) for t in numbers]


NODE = {"id": np.int64, "feature": np.int64, "threshold": float, "weights": float, "fall": float}


def _small(held: DataFrame, parts: Callable, open_nodes: list, numbers: list[int], width: int, classes: int, seed: int,
           max_depth: int, k: int, cuts: Cuts) -> list[tuple[int, dict]]:
    """The subtrees of the open nodes, each grown where its rows are brought together."""
    if not open_nodes:
        return []

    def deal(batches):
        for b in batches:
            for place, i, x, y, w in parts(b):
                yield pa.RecordBatch.from_arrays([
                    pa.array([numbers[place]], pa.int32()), pa.array([i], pa.int64()),
                    *[pa.array([v.tobytes()], pa.binary()) for v in (x, y, w.astype(float))]], names=["t", "i", "x", "y", "w"])

    def grow(table: pa.Table) -> pa.Table:
        t, i = table["t"][0].as_py(), table["i"][0].as_py()
        x, y, w = [np.frombuffer(b"".join(table[c].to_pylist()), kind) for c, kind in (("x", np.uint8), ("y", np.uint8), ("w", float))]
        n = _subtree(x.reshape(-1, width), y.astype(np.int64), w, i, seed + t, max_depth, k, classes, cuts)
        return pa.table({"t": pa.array([t], pa.int32()), **{c: pa.array([np.ascontiguousarray(n[c], kind).tobytes()], pa.binary())
                                                             for c, kind in NODE.items()}})

    tasks = min(len(open_nodes), 4 * held.sparkSession.sparkContext.defaultParallelism)
    grown = (held.mapInArrow(deal, "t int, i long, x binary, y binary, w binary").repartition(tasks, "t", "i")
             .groupBy("t", "i").applyInArrow(grow, "t int, " + ", ".join(f"{c} binary" for c in NODE)).toArrow())
    return [(r["t"], {c: np.frombuffer(r[c], kind) for c, kind in NODE.items()}) for r in grown.to_pylist()]


def poisson_bags(ids: np.ndarray, numbers: list[int], seed: int, steps: list[float]) -> np.ndarray:
    """Poisson numbers with mean 1 by a hash of (row id, tree)."""
    base = _mixed(_mixed(ids.astype(np.int64).view(np.uint64)) ^ _mixed(np.array([seed], np.int64).view(np.uint64)))
    draws = _mixed(base[:, None] ^ _mixed(np.array(numbers, np.uint64) + np.uint64(1 << 32))[None, :])
    return np.searchsorted(np.array(steps), (draws >> np.uint64(12)).astype(float) / 2.0 ** 52, "right")
