"""Linear margins of all classes against the rest, fitted together.

The rows are packed once into blocks. A step is one pass over them that gives the hinge loss and its gradient of every
class still running, by matrix products; each class takes the steps of ``LinearSVC`` on its own (limited memory
quasi-Newton with orthants and a backtracking search, weighted deviations as scales, centred features), so its margin
is the one that ``LinearSVC`` finds. The driver holds coefficients and 2 x ``MEMORY`` vectors a class; rows stay where
they are.
"""

from __future__ import annotations

from collections.abc import Generator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.operators.paths import _blocks, packed, summed

MEMORY = 10
LOSSES_KEPT = 20
ARMIJO, WOLFE = 1e-4, 0.9
MOST_TRIALS = 20
Calls = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


class StepFailed(Exception):
    """No descent along a direction."""


@dataclass
class Margin:
    coefficients: DenseVector
    intercept: float


@dataclass
class Margins:
    """A fitted margin per class; the prediction is the class with the largest one."""

    models: list[Margin]

    def transform(self, table: DataFrame) -> DataFrame:
        weights = np.stack([m.coefficients.toArray() for m in self.models])
        intercepts = np.array([m.intercept for m in self.models])

        @F.pandas_udf("double")
        def largest(x: pd.Series) -> pd.Series:
            if len(x) == 0:
                return pd.Series([], dtype="float64")
            return pd.Series(np.argmax(np.stack(x.to_numpy()) @ weights.T + intercepts, axis=1).astype(float))

        return table.withColumn("prediction", largest(vector_to_array("features")))


def _direction(slope: np.ndarray, moves: list[np.ndarray], turns: list[np.ndarray]) -> np.ndarray:
    """Quasi-Newton direction from the latest moves and changes of slope (newest first), downhill in every coordinate."""
    out, sized = slope.copy(), []
    scale = 1.0
    if moves:
        bend = moves[0] @ turns[0]
        if not bend >= 0:
            raise StepFailed
        scale = bend / (turns[0] @ turns[0])
    for move, turn in zip(moves, turns):
        size = move @ out / (move @ turn)
        if np.isnan(size):
            raise StepFailed
        sized.append(size)
        out -= size * turn
    out *= scale
    for move, turn, size in zip(moves[::-1], turns[::-1], sized[::-1]):
        out += (size - turn @ out / (move @ turn)) * move
    return np.where(-out * slope < 0, -out, 0.0)


def _descent(width: int, most_steps: int, tolerance: float) -> Calls:
    """Yields points, is sent their loss and slope, returns the last point."""
    at = np.zeros(width)
    loss, slope = yield at
    first, recent, moves, turns = abs(loss), [np.inf], [], []
    step, failed = 0, False
    while step < most_steps and abs(loss - max(recent)) > tolerance * first and np.linalg.norm(slope) > max(tolerance * loss, 1e-8):
        try:
            way = _direction(slope, moves, turns)
            side = np.sign(np.where(at != 0, at, -slope))

            def moved(length: float) -> np.ndarray:
                new = at + way * length
                return np.where(np.sign(new) == side, new, 0.0)

            down = slope @ way
            length, shrink = (0.5 / np.linalg.norm(slope), 0.1) if step < 1 else (1.0, 0.5)
            # The search takes the first length to lose as much as the start, so it always shrinks it; only where that
            # shows in no digit of the loss does the pass over the rows count.
            start = 1 if loss > loss + length * down * ARMIJO else 0
            length *= shrink if start else 1.0
            found = moved(length)
            there = yield found
            shown = there[0] if start else loss
            for trial in range(start, MOST_TRIALS):
                chosen = found, there
                steep = there[1] @ way
                if shown > loss + length * down * ARMIJO:
                    length *= shrink
                elif steep < WOLFE * down:
                    length *= 2.1
                elif steep > -WOLFE * down:
                    length *= shrink
                else:
                    break
                if not 1e-10 <= length <= 1e10:
                    raise StepFailed
                found = moved(length)
                there = yield found
                shown = there[0]
        except StepFailed:
            if failed:
                break
            failed, moves, turns = True, [], []
            continue
        new, (loss, new_slope) = chosen
        moves, turns = [new - at, *moves][:MEMORY], [new_slope - slope, *turns][:MEMORY]
        at, slope, step, failed = new, new_slope, step + 1, False
        recent = [*recent, loss][-LOSSES_KEPT:]
    return at


def fit_margins(table: DataFrame, margin: LinearSVC) -> Margins:
    """A margin with the settings of ``margin`` for every class of ``table`` (label, weight, features); rows without a
    label are left out."""
    rows = table.filter("label IS NOT NULL")
    about = rows.agg(F.max("label").alias("last"), F.sum("weight").alias("mass"),
                     Summarizer.metrics("mean", "std").summary(F.col("features"), F.col("weight")).alias("s")).first()
    classes, mass = int(about["last"]) + 1, about["mass"]
    spread = about["s"]["std"].toArray()
    scale = np.divide(1.0, spread, out=np.zeros_like(spread), where=spread != 0)
    centre = about["s"]["mean"].toArray() * scale
    strength = margin.getRegParam() * (np.ones_like(scale) if margin.getStandardization() else scale**2)
    width = len(scale) + 1
    blocks = packed(rows, True)

    def losses(own: list[int], points: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
        at = np.stack(points)
        coefs = np.column_stack([at[:, :-1] * scale, at[:, -1] - at[:, :-1] @ centre])
        kinds = np.array(own)

        def measure(batches):
            loss, slope = np.zeros(len(coefs)), np.zeros(coefs.shape)
            for _, x, y, w in _blocks(batches, width):
                side = np.where(y[:, None] == kinds, 1.0, -1.0)
                short = 1.0 - side * (x @ coefs.T)
                inside = np.where(short > 0, w[:, None], 0.0)
                loss += (inside * short).sum(axis=0)
                slope -= (inside * side).T @ x
            return np.column_stack([slope, loss]).ravel()

        found = summed(blocks, measure).reshape(len(coefs), -1) / mass
        loss = found[:, -1] + 0.5 * (at[:, :-1] ** 2 @ strength)
        slope = np.column_stack([found[:, :-2] * scale - found[:, -2:-1] * centre + at[:, :-1] * strength, found[:, -2]])
        return list(zip(loss.tolist(), slope))

    running = {c: _descent(width, margin.getMaxIter(), margin.getTol()) for c in range(classes)}
    asked, done = {c: next(run) for c, run in running.items()}, {}
    while asked:
        own = list(asked)
        for c, known in zip(own, losses(own, [asked[c] for c in own])):
            try:
                asked[c] = running[c].send(known)
            except StopIteration as end:
                done[c] = end.value
                del asked[c]
    blocks.unpersist()
    return Margins([Margin(DenseVector(done[c][:-1] * scale), float(done[c][-1] - done[c][:-1] @ centre)) for c in range(classes)])
