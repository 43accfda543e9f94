"""Whitening of embeddings on the leading components of their covariance.

Entries become whole numbers x = floor(SCALE * c) + OFFSET. The fit list is every distinct x
vector once. Passes over it, all in Arrow batches and merged by Spark aggregates: counts and
exact sums; products of centred entries; the covariance of the whitened fit list as a check.
The driver holds numbers per dimension and pair of dimensions, never rows; there the
covariance's leading eigenpairs come from ``spectrum.leading_pairs``. One more pass over all
rows projects them.

Defined cases: rows whose vector is null or empty, or holds null, NaN or infinite entries,
are left out; so are vectors of another length than the most frequent one (the greater of
equally frequent). Products SCALE * c beyond +-2^62 count as +-2^62. Ids are carried as they
are, null and repeated ones too; repeated rows give repeated results. With fewer dimensions
than components there are as many components as dimensions. A component without variance has
``whitened`` null; ``identity_error`` covers the others and is null without any. ``deviation``
is null where it exceeds a long. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.common import cut
from quillstat.llm.spectrum import leading_pairs

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
LIMIT = 2 ** 62
EPS = np.finfo(float).eps


@dataclass(frozen=True)
class Whitening:
    """What the fit list says: its size, exact sums, components (rows), their eigenvalues, and the check."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    positive: np.ndarray
    identity_error: float | None


def whole_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, x of every row that stays."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    rows = df.filter(F.col(vector).isNotNull() & (F.size(vector) > 0)).filter(good)
    common = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    scaled = lambda c: F.least(F.greatest(c.cast("double") * SCALE, F.lit(-float(LIMIT))), F.lit(float(LIMIT)))
    return rows.filter(F.size(vector) == (common["d"] if common else 0)).select(
        F.col(key).alias("_key"), F.transform(vector, lambda c: F.floor(scaled(c)) + F.lit(OFFSET).cast("long")).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def exact(x: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers, for sums and products beyond 64 bits."""
    return x.astype(object)


def times_n_less_sums(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S, exact: 64-bit where it fits, else Python integers."""
    most = int(np.abs(x).max(initial=0)) * n + max(abs(int(s)) for s in sums)
    return x * n - sums.astype(np.int64) if most < LIMIT else exact(x) * n - sums


def deviations(away: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exact; None beyond a long."""
    most = int(np.abs(away).max(initial=0))
    if most * most * away.shape[1] >= LIMIT:
        away = exact(away)
    return [int(v) if v < 2 ** 63 else None for v in (away * away).sum(axis=1)]


def _totals(fit: DataFrame, measure: Callable[[np.ndarray], np.ndarray], kind: str) -> list:
    """Sums of ``measure`` over all rows of the fit list, one array entry after another: each task adds up
    its own rows, Spark adds the tasks' arrays."""
    exact_type = kind.startswith("decimal")
    arrow = pa.decimal128(38, 0) if exact_type else pa.float64()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = measure(_matrix(batch.column(0)))
                total = part if total is None else total + part
        if total is not None:
            values = [Decimal(int(v)) for v in total] if exact_type else total
            yield pa.RecordBatch.from_arrays([pa.array([values], pa.list_(arrow))], ["parts"])

    parts = fit.mapInArrow(add, f"parts array<{kind}>").select(F.posexplode("parts").alias("at", "v"))
    return [r["v"] for r in parts.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()]


def fit_whitening(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``whole_vectors``' rows; None if there are none."""
    fit = cut(vectors.select("x").distinct())

    def counted(x: np.ndarray) -> np.ndarray:
        safe = int(np.abs(x).max(initial=0)) * len(x) < LIMIT
        return np.append(exact((x if safe else exact(x)).sum(axis=0)), len(x))

    *sums, n = [int(v) for v in _totals(fit, counted, "decimal(38,0)")] or [0]
    if n == 0:
        return None
    wide = np.array(sums, dtype=object)
    upper = np.triu_indices(len(sums))

    def products(x: np.ndarray) -> np.ndarray:
        centred = times_n_less_sums(x, n, wide).astype(float) / n
        return (centred.T @ centred)[upper]

    covariance = np.zeros((len(sums), len(sums)))
    covariance[upper] = np.array(_totals(fit, products, "double")) / n
    covariance = covariance + np.triu(covariance, 1).T
    values, vectors_ = leading_pairs(covariance, components)
    trace = float(np.trace(covariance))
    positive = values > 4 * len(sums) * EPS * trace
    axes = vectors_[positive] / np.sqrt(values[positive])[:, None]

    def check(x: np.ndarray) -> np.ndarray:
        w = (times_n_less_sums(x, n, wide).astype(float) / n) @ axes.T
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    k = int(positive.sum())
    error = None
    if k:
        found = np.array(_totals(fit, check, "double")) / n
        mean, second = found[:k], found[k:].reshape(k, k)
        error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    return Whitening(n, tuple(sums), vectors_, values, values / trace if trace else values * 0, positive, error)


def whiten(vectors: DataFrame, model: Whitening) -> DataFrame:
    """_key, deviation and the array ``whitened`` (null entries for components without variance) of every row."""
    n, sums = model.n, np.array(model.sums, dtype=object)
    scale = np.sqrt(np.where(model.positive, model.eigenvalues, 1.0))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            away = times_n_less_sums(_matrix(batch.column(1)), n, sums)
            w = (away.astype(float) / n) @ model.components.T / scale
            known = np.broadcast_to(model.positive, w.shape).ravel()
            ends = np.arange(0, w.size + 1, w.shape[1], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(deviations(away), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(w.ravel(), mask=~known))],
                ["_key", "deviation", "whitened"])

    kind = vectors.schema["_key"].dataType.simpleString()
    return vectors.mapInArrow(project, f"_key {kind}, deviation long, whitened array<double>")


def whitened_rows(df: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key, component (from 1), n, deviation, whitened, explained, identity_error: a row for each row that stays and component."""
    rows = whole_vectors(df, key, vector)
    model = fit_whitening(rows, components)
    if model is None:
        kind = df.schema[key].dataType.simpleString()
        return df.sparkSession.createDataFrame(
            [], f"{key} {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    shares = F.array(*[F.lit(float(v)) for v in model.explained])
    return whiten(rows, model).select("_key", "deviation", F.posexplode("whitened").alias("_at", "whitened")).select(
        F.col("_key").alias(key), (F.col("_at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
        "whitened", shares[F.col("_at")].alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))
