"""Correlation pairs, variance inflation, feature clusters and redundancy.

Data rows are read by one aggregation. What follows works on tables with one row
per feature or per feature pair.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillstat.functions.scalars import VIF_STRONG, VIF_WARNING, correlation, finite_or, is_finite, partial_r2, vif_flag, vif_from_r2

# Fixed values.
PAIR_THRESHOLDS = (0.5, 0.7, 0.8, 0.9, 0.95)
WIDE_PAIR_THRESHOLDS = (0.5, 0.7, 0.8, 0.9, 0.95, 0.99)
HIGH_PAIR = 0.80
WIDE_HIGH_PAIR = 0.90
CLUSTER_DISTANCE = 0.2
TOP_PAIRS = 200

SQL_FEATURES = 8  # up to here all pairs fit in one generated aggregate
BLOCK_FEATURES = 128
CHUNK = 200  # expressions per aggregate
MAX_FEATURES = 5_000  # for VIF alone: the inverse of a p x p matrix is taken on the driver


def _inline(rows: list[Column]) -> Column:
    return F.inline(F.array(*rows))


def pair_correlations(df: DataFrame, features: Sequence[str], undefined: float | None = None) -> DataFrame:
    """(feature_1, feature_2, correlation, abs_correlation) for features in order i < j.

    Each pair is taken over the rows where both values are present (not null, not NaN), for
    any number of features. Up to ``SQL_FEATURES`` one generated aggregate does it; more are
    read in blocks of features, which gives the same numbers. An undefined correlation becomes
    ``undefined``.
    """
    doubles = df.select(*[F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")).alias(f) for f in features])
    if len(features) <= SQL_FEATURES:
        spots = [(i, j) for i in range(len(features)) for j in range(i + 1, len(features))]
        full = doubles.agg(F.count(F.lit(1)).alias("_n"), *[F.count(f"`{f}`").alias(f) for f in features]).first()
        whole = [full[f] == full["_n"] for f in features]
        row = doubles.agg(*[
            correlation(f"`{features[i]}`", f"`{features[j]}`", whole[i] and whole[j]).alias(f"r{i}_{j}") for i, j in spots])
        cells = [
            F.struct(F.lit(features[i]).alias("feature_1"), F.lit(features[j]).alias("feature_2"),
                     finite_or(F.col(f"r{i}_{j}"), undefined).alias("correlation"))
            for i, j in spots
        ]
        pairs = row.select(_inline(cells))
    else:
        dim = df.sparkSession.createDataFrame(list(enumerate(features)), "p int, f string")
        name = lambda end, column: F.broadcast(dim.select(F.col("p").alias(end), F.col("f").alias(column)))
        pairs = _block_correlations(doubles, features).join(name("i", "feature_1"), "i").join(name("j", "feature_2"), "j").select(
            "feature_1", "feature_2", finite_or(F.col("correlation"), undefined).alias("correlation"))
    return pairs.withColumn("abs_correlation", F.abs("correlation"))


def _block_correlations(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(i, j, correlation), i < j, from sums over rows kept per pair of feature blocks.

    A task hands on one array of sums per block pair, whatever its rows; the sums of a block
    pair meet in one aggregate buffer and never leave the executors.
    """
    mean: list[float] = []
    for k in range(0, len(features), CHUNK):
        mean += [v or 0.0 for v in df.agg(*[F.avg(f"`{f}`") for f in features[k:k + CHUNK]]).first()]
    centre, p = np.array(mean), len(features)
    spans = [(k, min(k + BLOCK_FEATURES, p)) for k in range(0, p, BLOCK_FEATURES)]

    def partial(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            rows = np.array(batch["_x"].tolist(), dtype=float).reshape(len(batch), p)
            here = ~np.isnan(rows)
            x = np.where(here, rows - centre, 0.0)
            m, square = here.astype(float), x * x
            for bi, (a, b) in enumerate(spans):
                for bj, (c, d) in enumerate(spans[bi:], bi):
                    part = np.stack([
                        m[:, a:b].T @ m[:, c:d], x[:, a:b].T @ m[:, c:d], m[:, a:b].T @ x[:, c:d],
                        square[:, a:b].T @ m[:, c:d], m[:, a:b].T @ square[:, c:d], x[:, a:b].T @ x[:, c:d]])
                    if (bi, bj) in sums:
                        sums[bi, bj] += part
                    else:
                        sums[bi, bj] = part
        for (bi, bj), part in sums.items():
            yield pd.DataFrame({"bi": [bi], "bj": [bj], "s": [part.ravel()]})

    def finish(batches):
        for batch in batches:
            for bi, bj, s in zip(batch["bi"], batch["bj"], batch["s"]):
                (a, b), (c, d) = spans[bi], spans[bj]
                n, sx, sy, xx, yy, xy = np.asarray(s).reshape(6, b - a, d - c)
                with np.errstate(divide="ignore", invalid="ignore"):
                    vx, vy = xx - sx * sx / n, yy - sy * sy / n
                    # What rounding leaves of a constant column is no spread.
                    flat = (vx <= 1e-13 * xx) | (vy <= 1e-13 * yy)
                    r = np.where(flat, np.nan, (xy - sx * sy / n) / np.sqrt(vx * vy))
                i, j = np.meshgrid(np.arange(a, b), np.arange(c, d), indexing="ij")
                keep = i < j
                yield pd.DataFrame({"i": i[keep], "j": j[keep], "correlation": r[keep]})

    rows = df.select(F.array(*[F.col(f"`{f}`") for f in features]).alias("_x")).mapInPandas(
        partial, "bi int, bj int, s array<double>")
    whole = rows.groupBy("bi", "bj").agg(Summarizer.sum(array_to_vector("s")).alias("s")).select(
        "bi", "bj", vector_to_array("s").alias("s"))
    return whole.mapInPandas(finish, "i int, j int, correlation double")


def correlation_matrix(df: DataFrame, features: Sequence[str] | str) -> np.ndarray:
    """p x p matrix of complete rows, from named columns or one vector column."""
    if isinstance(features, str):
        vectors, column = df.select(features), features
    else:
        if len(features) > MAX_FEATURES:
            raise ValueError(f"{len(features)} features exceed the bound of {MAX_FEATURES}")
        vectors, column = VectorAssembler(inputCols=list(features), outputCol="_v").transform(df).select("_v"), "_v"
    return Correlation.corr(vectors, column).first()[0].toArray()


def both_ways(pairs: DataFrame) -> DataFrame:
    """Each pair once from either end, as (feature, other, correlation, abs_correlation)."""
    value = ["correlation", "abs_correlation"]
    ends = F.explode(F.array(
        F.struct(F.col("feature_1").alias("feature"), F.col("feature_2").alias("other")),
        F.struct(F.col("feature_2").alias("feature"), F.col("feature_1").alias("other")),
    )).alias("e")
    return pairs.select(ends, *value).select("e.feature", "e.other", *value)


def full_matrix(pairs: DataFrame, features: Sequence[str]) -> DataFrame:
    """Long symmetric matrix with its diagonal."""
    diagonal = pairs.sparkSession.createDataFrame([(f,) for f in features], "feature string").select(
        "feature", F.col("feature").alias("other"), F.lit(1.0).alias("correlation"))
    return both_ways(pairs).select("feature", "other", "correlation").unionByName(diagonal)


def high_pairs(pairs: DataFrame, threshold: float = HIGH_PAIR) -> DataFrame:
    return pairs.filter(F.col("abs_correlation") >= threshold)


def top_pairs(pairs: DataFrame, n: int = TOP_PAIRS) -> DataFrame:
    return pairs.orderBy(F.desc("abs_correlation"), "feature_1", "feature_2").limit(n)


def threshold_counts(pairs: DataFrame, thresholds: Sequence[float] = PAIR_THRESHOLDS) -> DataFrame:
    """Pairs at or above each threshold and their share, zero counts included."""
    hits = [F.count(F.when(F.col("abs_correlation") >= t, 1)).alias(f"t{i}") for i, t in enumerate(thresholds)]
    cells = [
        F.struct(F.lit(float(t)).alias("abs_correlation_threshold"), F.col(f"t{i}").alias("n_pairs"),
                 F.try_divide(F.col(f"t{i}"), F.col("n")).alias("pct_pairs"))
        for i, t in enumerate(thresholds)
    ]
    return pairs.agg(F.count(F.lit(1)).alias("n"), *hits).select(_inline(cells))


def correlation_summary(pairs: DataFrame) -> DataFrame:
    """Per feature: mean, median, max of |r| to the others and counts over 0.7, 0.8, 0.9."""
    r = F.col("abs_correlation")
    return both_ways(pairs).groupBy("feature").agg(
        F.avg(r).alias("mean_abs_correlation"), F.median(r).alias("median_abs_correlation"),
        F.max(r).alias("max_abs_correlation"),
        *[F.count(F.when(r >= t / 100, 1)).alias(f"n_corr_ge_0_{t}") for t in (70, 80, 90)],
    )


def correlation_overview(pairs: DataFrame) -> DataFrame:
    r = F.col("abs_correlation")
    return pairs.agg(
        F.max(r).alias("max_abs_correlation"), F.avg(r).alias("mean_abs_correlation"),
        F.median(r).alias("median_abs_correlation"), F.count(F.lit(1)).alias("n_pairs"),
    )


# --- variance inflation --------------------------------------------------------------

def vif_table(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """R2 of each feature on all others, partial R2, VIF and flag.

    1 - R2 is the inverse of the diagonal of the inverse correlation matrix, so one
    pass over the rows replaces p regressions. Constant features count as perfectly
    explained and do not take part in the others' regressions.
    """
    r = correlation_matrix(df, list(features))
    constant = (np.isnan(r) | np.eye(len(features), dtype=bool)).all(axis=1) & (len(features) > 1)
    inflation = np.full(len(features), np.inf)
    live = np.flatnonzero(~constant)
    values, vectors = np.linalg.eigh(r[np.ix_(live, live)])
    floor = np.finfo(float).eps
    inflation[live] = (vectors**2 / np.maximum(values, floor)).sum(axis=1)
    r2 = np.clip(1.0 - 1.0 / inflation, 0.0, 1.0)
    table = pd.DataFrame({"feature": list(features), "r2_against_other_features": r2})
    base = df.sparkSession.createDataFrame(table, "feature string, r2_against_other_features double")
    return (
        base.withColumn("vif", vif_from_r2(F.col("r2_against_other_features")))
        .withColumn("partial_r2", partial_r2(F.col("vif")))
        .withColumn("vif_flag", vif_flag(F.col("vif")))
    )


def high_vif(vif: DataFrame, threshold: float = VIF_WARNING) -> DataFrame:
    return vif.filter(F.col("vif") >= threshold)


def capped_vif(vif: DataFrame, share: float = 0.95) -> DataFrame:
    """Finite VIFs capped at their 95th percentile, as charted."""
    finite = vif.filter(is_finite(F.col("vif")))
    return finite.withColumn("cap", F.percentile("vif", F.lit(share)).over(W.partitionBy())).withColumn(
        "capped_vif", F.least("vif", "cap"))


def vif_status(n: Column, p: Column) -> Column:
    return F.when(p > n, "skipped_p_greater_than_n").otherwise("computed")


# --- redundancy ----------------------------------------------------------------------

def with_cluster_size(labels: DataFrame) -> DataFrame:
    return labels.withColumn("cluster_size", F.count(F.lit(1)).over(W.partitionBy("cluster_id")))


def cluster_overview(clusters: DataFrame) -> DataFrame:
    one_each = clusters.select("cluster_id", "cluster_size").distinct()
    return one_each.agg(
        F.count(F.lit(1)).alias("n_clusters"), F.count(F.when(F.col("cluster_size") > 1, 1)).alias("n_non_singleton"),
        F.max("cluster_size").alias("largest_cluster"),
    )


def redundancy_candidates(summary: DataFrame, vif: DataFrame, clusters: DataFrame) -> DataFrame:
    """Features with any sign of redundancy and their score."""
    merged = (
        summary.join(vif.select("feature", "vif", "partial_r2", "vif_flag"), "feature", "left")
        .join(clusters.select("feature", "cluster_id", "cluster_size"), "feature", "left")
    )
    inflated = finite_or(F.col("vif"), VIF_STRONG) >= VIF_WARNING
    grouped = F.coalesce(F.col("cluster_size") > 1, F.lit(False))
    score = (
        F.col("n_corr_ge_0_80") + 2.0 * F.col("n_corr_ge_0_90")
        + inflated.cast("double") + grouped.cast("double")
    )
    sign = grouped | (F.col("n_corr_ge_0_80") > 0) | F.coalesce(F.col("vif") >= VIF_WARNING, F.lit(False))
    return merged.withColumn("redundancy_score", score).filter(sign)
