"""Principal components, k-means over many k, agreement with known classes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillstat.functions.ranking import first_reaching, hartigan, running_total
from quillstat.operators.linkage import complete_linkage, cut_tree
from quillstat.session import keep

# Fixed values.
VARIANCE_SHARE = 0.75
K_RANGE = tuple(range(2, 16))
RESTARTS = 20
SEED = 42
CLASS_COUNT = 3

SEED_ROWS = 10_000


# --- principal components ------------------------------------------------------------

@dataclass(frozen=True)
class Components:
    """Loadings (p x m), variance ratios and the mean that scores are centred on."""

    features: list[str]
    loadings: np.ndarray
    ratios: np.ndarray
    mean: np.ndarray


def fit_pca(df: DataFrame, vector: str, features: Sequence[str], standardised: bool = False) -> Components:
    """All components from the distributed covariance matrix.

    The sign of a component is fixed: its largest loading in size is positive. The covariance of
    ``standardised`` features is their correlation matrix, with a diagonal of exactly 1, and their mean is 0:
    rounding in their variances would turn the components of nearly uncorrelated features.
    """
    table = df.select(array_to_vector(F.col(vector)).alias("v"))
    if standardised:
        values, vectors = np.linalg.eigh(Correlation.corr(table, "v").first()[0].toArray())
        loadings, ratios, mean = vectors[:, ::-1], values[::-1] / len(features), np.zeros(len(features))
    else:
        model = PCA(k=len(features), inputCol="v", outputCol="s").fit(table)
        loadings, ratios = model.pc.toArray(), model.explainedVariance.toArray()
        mean = table.select(Summarizer.mean(F.col("v")).alias("m")).first()["m"].toArray()
    top = np.abs(loadings).argmax(axis=0)
    loadings = loadings * np.sign(loadings[top, np.arange(loadings.shape[1])])
    return Components(list(features), loadings, ratios, mean)


def variance_table(spark, parts: Components) -> DataFrame:
    """(pc, explained, cumulative), pc counted from 1."""
    rows = spark.createDataFrame([(i + 1, float(r)) for i, r in enumerate(parts.ratios)], "pc int, explained double")
    return rows.withColumn("cumulative", running_total(F.col("explained"), F.col("pc")))


def components_for(variance: DataFrame, share: float = VARIANCE_SHARE) -> DataFrame:
    return first_reaching(variance, "pc", "cumulative", share, "n_components")


def loadings_table(spark, parts: Components) -> DataFrame:
    p, m = parts.loadings.shape
    table = pd.DataFrame({
        "feature": np.repeat(parts.features, m), "pc": np.tile(np.arange(1, m + 1), p), "loading": parts.loadings.ravel()})
    return spark.createDataFrame(table, "feature string, pc int, loading double")


def top_loadings(loadings: DataFrame, n: int = 15, pcs: Sequence[int] = (1, 2)) -> DataFrame:
    """The n largest loadings by size of each component, with their place by sign."""
    by = W.partitionBy("pc")
    ranked = loadings.filter(F.col("pc").isin(list(pcs))).withColumn(
        "rank", F.row_number().over(by.orderBy(F.desc(F.abs("loading")), "feature")))
    return ranked.filter(F.col("rank") <= n).withColumn("place", F.row_number().over(by.orderBy("loading", "feature")))


def with_scores(df: DataFrame, vector: str, parts: Components, m: int, name: str = "scores") -> DataFrame:
    """Array of the first m centred scores, computed from literals on the JVM."""
    offset = parts.mean @ parts.loadings[:, :m]
    dot = lambda j: F.aggregate(
        F.zip_with(F.col(vector), F.lit(parts.loadings[:, j].tolist()), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    return df.withColumn(name, F.array(*[dot(j) - F.lit(float(offset[j])) for j in range(m)]))


# --- k-means over a range of k -------------------------------------------------------

@dataclass(frozen=True)
class KMeansFit:
    k: int
    centres: np.ndarray
    inertia: float


def kmeans_sweep(
    df: DataFrame, vector: str, ks: Sequence[int] = K_RANGE, restarts: int = RESTARTS, seed: int = SEED,
    rounds: int = 300, tol: float = 1e-4,
) -> dict[int, KMeansFit]:
    """Best of ``restarts`` k-means fits for each k.

    All (k, restart) fits advance together: one pass over the rows per round gives
    the new centres of every fit that still moves, instead of one pass per fit and
    round. Starting centres are spread out over at most ``SEED_ROWS`` rows, those with the
    least hashes of their vector: the same rows, in the same order, for any partitioning.
    """
    rows = keep(df.select(F.col(vector).cast("array<double>").alias("x")))
    n = rows.count()
    mark = F.pmod(F.xxhash64(F.lit(seed), "x"), F.lit(1 << 30))
    share = min(1.0, (1.2 * SEED_ROWS + 100) / max(n, 1))
    start = rows.select("x", mark.alias("m")).filter(F.col("m") < int(share * (1 << 30))).orderBy("m", "x").limit(SEED_ROWS)
    sample = np.array([r["x"] for r in start.collect()], dtype=float)
    spread = rows.select(Summarizer.variance(array_to_vector("x")).alias("v")).first()["v"].toArray().mean()
    rng = np.random.default_rng(seed)
    open_fits = {(k, r): _spread_centres(sample, k, rng) for k in ks for r in range(restarts)}
    done: dict[tuple[int, int], tuple[float, np.ndarray]] = {}
    for step in range(rounds + 1):
        moved, inertia = _assign_round(rows, open_fits)
        for key in list(open_fits):
            shift = float(((moved[key] - open_fits[key]) ** 2).sum())
            if shift <= tol * spread or step == rounds:
                done[key] = (inertia[key], open_fits.pop(key))
            else:
                open_fits[key] = moved[key]
        if not open_fits:
            break
    rows.unpersist()
    best = {}
    for k in ks:
        value, centres = min((done[(k, r)] for r in range(restarts)), key=lambda t: t[0])
        best[k] = KMeansFit(k, centres, value)
    return best


def _spread_centres(sample: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres drawn one by one with weight growing with the distance to those drawn."""
    centres = [sample[rng.integers(len(sample))]]
    gap = ((sample - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k:
        weight = gap / gap.sum() if gap.sum() > 0 else None
        centres.append(sample[rng.choice(len(sample), p=weight)])
        gap = np.minimum(gap, ((sample - centres[-1]) ** 2).sum(axis=1))
    return np.array(centres)


def _assign_round(rows: DataFrame, fits: dict) -> tuple[dict, dict]:
    """New centres and inertia of every fit from one pass over the rows."""
    keys = list(fits)
    starts = np.cumsum([0] + [len(fits[k]) for k in keys])
    centres = np.concatenate([fits[k] for k in keys])

    def partial(batches):
        count = np.zeros(len(centres))
        total = np.zeros_like(centres)
        cost = np.zeros(len(centres))
        for batch in batches:
            if not batch.num_rows:
                continue
            points = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            for at in range(0, len(points), 1024):
                x = points[at : at + 1024]
                square = (x**2).sum(axis=1)
                gap = np.maximum(square[:, None] - 2.0 * x @ centres.T + (centres**2).sum(axis=1)[None, :], 0.0)
                for a, z in zip(starts[:-1], starts[1:]):
                    nearest = gap[:, a:z].argmin(axis=1)
                    member = (nearest[None, :] == np.arange(z - a)[:, None]).astype(float)
                    count[a:z] += member.sum(axis=1)
                    total[a:z] += member @ x
                    cost[a] += gap[np.arange(len(x)), a + nearest].sum()
        hit = np.flatnonzero((count > 0) | (cost > 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(hit, pa.int32()), pa.array(count[hit]), pa.array(cost[hit]), pa.array(list(total[hit]), pa.list_(pa.float64()))],
            ["c", "n", "cost", "s"])

    sums = rows.mapInArrow(partial, "c int, n double, cost double, s array<double>")
    merged = sums.groupBy("c").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), Summarizer.sum(array_to_vector("s")).alias("s")).collect()
    new, cost = centres.copy(), np.zeros(len(centres))
    for r in merged:
        if r["n"] > 0:
            new[r["c"]] = r["s"].toArray() / r["n"]
        cost[r["c"]] = r["cost"]
    moved = {k: new[a:z] for k, a, z in zip(keys, starts[:-1], starts[1:])}
    return moved, {k: float(cost[a:z].sum()) for k, a, z in zip(keys, starts[:-1], starts[1:])}


def nearest_centre(vector: Column, centres: np.ndarray) -> Column:
    """Index of the nearest centre, from literals on the JVM."""
    def gap(c):
        pairs = F.zip_with(vector, F.lit(list(map(float, c))), lambda a, b: (a - b) * (a - b))
        return F.aggregate(pairs, F.lit(0.0), lambda a, b: a + b)

    return F.array_min(F.array(*[
        F.struct(gap(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]))["i"]


def inertia_table(spark, fits: dict[int, KMeansFit], n: int) -> DataFrame:
    """(k, inertia, hartigan) for the curves over k."""
    rows = spark.createDataFrame([(k, f.inertia) for k, f in fits.items()], "k int, inertia double")
    return rows.withColumn("hartigan", hartigan(F.col("inertia"), F.col("k"), F.lit(n)))


# --- hierarchical clustering of rows -------------------------------------------------

def exact_row_clusters(df: DataFrame, key: str, vector: str, clusters: Sequence[int]) -> DataFrame:
    """Complete-linkage clusters with every row a leaf, one column ``k<n>`` per wanted count.

    All pairs of rows are compared, so this is for a table the caller knows to be small; the
    form for any table is ``centroid_row_clusters``.
    """
    points = df.select(key, F.col(vector).cast("array<double>").alias("x"))
    leaves = points.withColumn("node", F.row_number().over(W.orderBy(key)) - 1)
    return _cut_columns(leaves, leaves.select(key, "node"), leaves.count(), clusters)


def centroid_row_clusters(df: DataFrame, key: str, vector: str, clusters: Sequence[int], leaves: int) -> DataFrame:
    """Complete-linkage clusters over ``leaves`` k-means centres of all rows; each row takes
    the cluster of its centre. The same way at every size; no row is left out."""
    points = df.select(key, F.col(vector).cast("array<double>").alias("x"))
    centres = kmeans_sweep(points, "x", [leaves], 1)[leaves].centres
    nodes = df.sparkSession.createDataFrame([(i, c.tolist()) for i, c in enumerate(centres)], "node int, x array<double>")
    return _cut_columns(nodes, _place(points, key, centres), len(centres), clusters)


def _cut_columns(leaves: DataFrame, placed: DataFrame, n: int, clusters: Sequence[int]) -> DataFrame:
    merges = complete_linkage(leaf_distances(leaves), n)
    out = placed
    for k in clusters:
        labels = cut_tree(merges, n, clusters=k).withColumnRenamed("cluster_id", f"k{k}")
        out = out.join(F.broadcast(labels), "node")
    return out.drop("node")


def _place(points: DataFrame, key: str, centres: np.ndarray) -> DataFrame:
    """Nearest of many centres for every row, in Arrow batches."""
    @F.pandas_udf("int")
    def nearest(x: pd.Series) -> pd.Series:
        out = []
        values = np.stack(x.to_numpy()) if len(x) else np.empty((0, centres.shape[1]))
        for at in range(0, len(values), 1024):
            part = values[at : at + 1024]
            out.append((-2.0 * part @ centres.T + (centres**2).sum(axis=1)[None, :]).argmin(axis=1))
        return pd.Series(np.concatenate(out) if out else [], dtype="int32")

    return points.select(key, nearest("x").alias("node"))


def leaf_distances(leaves: DataFrame) -> DataFrame:
    """(i, j, d) for i < j over a bounded leaf table."""
    last = leaves.agg(F.max("node")).first()[0]
    a = leaves.filter(F.col("node") < last).select(
        F.col("node").alias("i"), F.col("x").alias("u"), F.explode(F.sequence(F.col("node") + 1, F.lit(last))).alias("j"))
    b = leaves.select(F.col("node").alias("j"), F.col("x").alias("v"))
    square = F.aggregate(F.zip_with("u", "v", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, t: s + t)
    return a.join(F.broadcast(b), "j").select("i", "j", F.sqrt(square).alias("d"))


# --- agreement of two labelings ------------------------------------------------------

def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index and normalised mutual information from the contingency table."""
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    return agreement_of(cells)


def agreement_of(cells: DataFrame) -> DataFrame:
    """The same from (a, b, n) cells: one row per pair of labels seen together."""
    cells = cells.filter("n > 0")
    by_a, by_b, whole = W.partitionBy("a"), W.partitionBy("b"), W.partitionBy()
    x = cells.select(
        "a", "b", F.col("n").cast("double").alias("n"), F.sum("n").over(by_a).cast("double").alias("na"),
        F.sum("n").over(by_b).cast("double").alias("nb"), F.sum("n").over(whole).cast("double").alias("t"),
    )
    pairs = lambda c: c * (c - 1) / 2
    n, na, nb, t = (F.col(c) for c in ("n", "na", "nb", "t"))
    sums = x.agg(
        F.sum(pairs(n)).alias("both"),
        # each row total appears once per cell of its row: spread it by the cell's share
        F.sum(pairs(na) * n / na).alias("in_a"), F.sum(pairs(nb) * n / nb).alias("in_b"), F.max(pairs(t)).alias("all"),
        F.sum(n / t * F.log(n * t / (na * nb))).alias("mi"),
        F.sum(-n / t * F.log(na / t)).alias("ha"), F.sum(-n / t * F.log(nb / t)).alias("hb"),
    )
    expected = F.try_divide(F.col("in_a") * F.col("in_b"), F.col("all"))
    top = (F.col("in_a") + F.col("in_b")) / 2
    return sums.select(
        F.coalesce(F.try_divide(F.col("both") - expected, top - expected), F.lit(1.0)).alias("adjusted_rand_index"),
        F.when(F.col("ha") + F.col("hb") > 0, F.greatest(F.col("mi"), F.lit(0.0)) / ((F.col("ha") + F.col("hb")) / 2))
        .otherwise(1.0).alias("normalized_mutual_information"),
    )
