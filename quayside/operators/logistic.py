"""Many logistic models fitted at once: settings, folds and sets of features share every pass over the rows.

An iteration is one job. It multiplies the rows by the coefficients of all models that are not yet done, and adds up
each model's loss, gradient and X'WX over the rows that the model may see. The steps themselves are small systems:
Newton's with an L2 penalty, coordinate descent on the same quadratic with an L1 penalty, halved where the objective
doesn't fall. The objective of a model is the summed loss of its rows plus 1/C times the penalty (half the squared, or
the absolute coefficients); the intercept is free.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, functions as F

from quayside.operators.metrics import classification_metrics
from quayside.plans.sums import keyed_sums, matrix

SCORES = ("accuracy", "balanced_accuracy", "f1", "weighted_f1", "precision", "recall", "roc_auc")
LOST = 1e-4  # the share of the expected fall of the objective that a step has to bring
SWEEPS = 300  # of coordinate descent per iteration; a step that is not quite there goes on with the next sums


class Fit(NamedTuple):
    """One model: its penalty, the fold that it doesn't see (None: it sees all rows), the places of its features."""

    C: float
    penalty: str
    fold: int | None
    used: tuple[int, ...]


class _State:
    """A fit on its way: the last accepted coefficients (intercept first), and the step that is tried."""

    def __init__(self, fit: Fit, width: int, start: np.ndarray | None):
        self.at = np.array([0, *[1 + i for i in fit.used]])
        self.strength, self.l1 = 1.0 / fit.C, fit.penalty == "l1"
        self.b = np.zeros(width + 1)
        if start is not None:
            self.b[self.at] = start[self.at]
        self.step, self.scale, self.best, self.fall, self.done = np.zeros(len(self.at)), 1.0, np.inf, 0.0, False

    def trial(self) -> np.ndarray:
        out = self.b.copy()
        out[self.at] += self.scale * self.step
        return out

    def penalty(self, b: np.ndarray) -> float:
        free = b[self.at][1:]
        return self.strength * float(np.abs(free).sum() if self.l1 else free @ free / 2)

    def accept(self, loss: float) -> bool:
        """Whether the objective at the trial point has fallen enough; it is the new point then, else the step halves."""
        trial = self.trial()
        value = loss + self.penalty(trial)
        if value > self.best - LOST * self.scale * self.fall + 1e-13 * abs(value) and self.scale > 1e-9:
            self.scale /= 2
            return False
        self.b, self.best, self.scale = trial, min(value, self.best), 1.0
        return True

    def aim(self, goal: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, tol: float) -> None:
        """Step to the goal next, unless that would hardly lower the objective."""
        self.step = (goal - self.b)[self.at]
        step = goal - self.b
        fall = self.penalty(self.b) - self.penalty(goal) - gradient @ step - step @ hessian @ step / 2
        self.fall = max(0.0, float(fall))
        if self.fall <= tol * max(1.0, abs(self.best)):
            self.b, self.done = goal, True

    def l2_goal(self, gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
        """Newton's."""
        at, goal = self.at, self.b.copy()
        ridge = np.full(len(at), self.strength)
        ridge[0] = 0.0
        goal[at] -= np.linalg.lstsq(hessian[np.ix_(at, at)] + np.diag(ridge), gradient[at] + ridge * self.b[at],
                                    rcond=None)[0]
        return goal


def l1_goals(b: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, strength: np.ndarray) -> np.ndarray:
    """The minima of many quadratics with an L1 penalty, a row each, by coordinate descent on all of them at once."""
    goal, slope = b.copy(), gradient.copy()  # the quadratics' gradients at the goals
    curve = np.diagonal(hessian, axis1=1, axis2=2)
    used = curve > 1e-12
    curve = np.where(used, curve, 1.0)
    for _ in range(SWEEPS):
        largest = 0.0
        for j in range(b.shape[1]):
            free = goal[:, j] - slope[:, j] / curve[:, j]
            cut = strength / curve[:, j] if j else 0.0
            to = np.where(used[:, j], np.sign(free) * np.maximum(np.abs(free) - cut, 0.0), goal[:, j])
            moved = to - goal[:, j]
            slope += hessian[:, :, j] * moved[:, None]
            goal[:, j] = to
            largest = max(largest, float(np.abs(moved).max()))
        if largest <= 1e-12 * max(1.0, float(np.abs(goal).max())):
            break
    return goal


class Fitted(NamedTuple):
    """A model with these features, which can be used like one of Spark's."""

    features: list[str]
    intercept: float
    coefficients: DenseVector

    @property
    def numFeatures(self) -> int:
        return len(self.features)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add margin, prediction and score (the probability of class 1) to a frame with the vector ``features``."""
        x = vector_to_array("features")
        margin = sum((x[i] * float(c) for i, c in enumerate(self.coefficients)), F.lit(float(self.intercept)))
        return df.withColumn("margin", margin).withColumns(
            {"prediction": (F.col("margin") > 0).cast("double"), "score": 1 / (1 + F.exp(-F.col("margin")))})


def arrayed(df: DataFrame, features: list[str] | str, label: str, fold: str | None) -> DataFrame:
    """Rows (x, y, fold) of a frame with columns or a vector of features; null labels and values count as 0.

    Without a fold column the fold is -1. Cache it for a fit: it is read once per iteration.
    """
    x = (vector_to_array(features) if isinstance(features, str)
         else F.array(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in features]))
    return df.select(x.alias("x"), F.coalesce(F.col(label).cast("double"), F.lit(0.0)).alias("y"),
                     (F.lit(-1) if fold is None else F.col(fold)).cast("int").alias("fold"))


def fit_many(rows: DataFrame, fits: Sequence[Fit], width: int, max_iter: int = 100, tol: float = 1e-10,
             start: np.ndarray | None = None) -> np.ndarray:
    """Coefficients of every fit on ``rows`` (x, y, fold), a row per fit: the intercept, then ``width`` features.

    ``start`` has coefficients to begin with. There are at most ``max_iter`` jobs, however many fits there are; a fit
    is done where the next step would lower its objective by less than ``tol`` of it. Features that a fit doesn't use
    have coefficient 0. Without rows all coefficients are 0.
    """
    states = [_State(f, width, None if start is None else start[i]) for i, f in enumerate(fits)]
    for _ in range(max_iter):
        left = [i for i, s in enumerate(states) if not s.done]
        if not left:
            break
        b = np.stack([states[i].trial() for i in left])
        unseen = np.array([-2 if fits[i].fold is None else fits[i].fold for i in left])

        def arrays(batch: pa.RecordBatch):
            x = np.column_stack([np.ones(batch.num_rows), matrix(batch.column(0), width)])
            y, fold = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            margin = x @ b.T
            sees = fold[:, None] != unseen[None, :]
            # log(1 + e^m) - y m, and the probability, without overflow.
            loss = np.where(sees, np.logaddexp(0.0, margin) - y[:, None] * margin, 0.0).sum(axis=0)
            p = np.exp(-np.logaddexp(0.0, -margin))
            off, weight = np.where(sees, p - y[:, None], 0.0), np.where(sees, p * (1 - p), 0.0)
            gradient = off.T @ x
            for k, i in enumerate(left):
                yield i, np.concatenate([[loss[k]], gradient[k], ((x * weight[:, k:k + 1]).T @ x).ravel()])

        sums = keyed_sums(rows, arrays)
        if not sums:
            break
        gradient = {i: v[1:width + 2] for i, v in sums.items()}
        hessian = {i: v[width + 2:].reshape(width + 1, width + 1) for i, v in sums.items()}
        moved = [i for i, v in sums.items() if states[i].accept(v[0])]
        lasso = [i for i in moved if states[i].l1]
        goals = {i: states[i].l2_goal(gradient[i], hessian[i]) for i in moved if not states[i].l1}
        if lasso:
            used = np.stack([np.isin(np.arange(width + 1), states[i].at) for i in lasso]).astype(float)
            goals |= zip(lasso, l1_goals(np.stack([states[i].b for i in lasso]),
                                         np.stack([gradient[i] for i in lasso]) * used,
                                         np.stack([hessian[i] for i in lasso]) * used[:, None, :] * used[:, :, None],
                                         np.array([states[i].strength for i in lasso])))
        for i, goal in goals.items():
            states[i].aim(goal, gradient[i], hessian[i], tol)
    return np.stack([s.b for s in states]) if states else np.zeros((0, width + 1))


def score_many(rows: DataFrame, fits: Sequence[Fit], coefficients: np.ndarray, score: str) -> list[float]:
    """The score of every fit on the rows of the fold that it hasn't seen; all fits in one pass.

    A fit scores 1 where the margin is above 0; the area under the curve is of the margins.
    """
    if score not in SCORES:
        raise ValueError(f"{score} is none of {', '.join(SCORES)}")
    tested = {fold: [i for i, f in enumerate(fits) if f.fold == fold] for fold in {f.fold for f in fits}}

    def judged(batches):
        for b in batches:
            x = np.column_stack([np.ones(b.num_rows), matrix(b.column(0), coefficients.shape[1] - 1)])
            y, fold = (b.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            for one in np.unique(fold).tolist():
                here = np.flatnonzero(fold == one)
                of = np.array(tested.get(one, []), int)
                margin = x[here] @ coefficients[of].T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(of, len(here)).astype(np.int32)), pa.array(np.repeat(y[here], len(of))),
                     pa.array((margin > 0).astype(float).ravel()), pa.array(margin.ravel())],
                    names=["fit", "y", "prediction", "score"])

    long = rows.mapInArrow(judged, "fit int, y double, prediction double, score double")
    found = classification_metrics(long, "y", "prediction", "score" if score == "roc_auc" else None, ("fit",))
    of = {r.fit: r[score] for r in found.select("fit", score).collect()}  # a row per fit
    return [float("nan") if of.get(i) is None else float(of[i]) for i in range(len(fits))]
