"""Components, k-means over k, hierarchical clusters and agreement with the classes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.functions.ranking import best_k
from quillstat.operators import neighbours, structure, summaries
from quillstat.operators.sampling import class_sizes
from quillstat.plans.tables import Tables
from quillstat.session import keep


def unsupervised(
    df: DataFrame, key: str, y: str, features: Sequence[str], ks: Sequence[int] = structure.K_RANGE,
    restarts: int = structure.RESTARTS, share: float = structure.VARIANCE_SHARE, exact_silhouette: bool = False,
    leaves: int = 200,
) -> Tables:
    """Explore standardised rows. Counts of clusters are compared by the silhouette of squared
    distances, which is linear in the rows; the exact one costs rows squared and is for small
    tables. The tree stands on ``leaves`` k-means centres of all rows."""
    spark = df.sparkSession
    rows = df.select(key, y, F.array(*features).alias("x"))
    parts = structure.fit_pca(rows, "x", features)
    variance = structure.variance_table(spark, parts)
    m = structure.components_for(variance, share).first()["n_components"]
    scored = keep(structure.with_scores(rows, "x", parts, m).select(key, y, "scores"))
    classes = sorted(str(c) for c in class_sizes(rows, y))
    fits = structure.kmeans_sweep(scored, "scores", ks, restarts)
    marked = scored.select("*", *[
        structure.nearest_centre(F.col("scores"), f.centres).alias(f"kmeans_k{k}") for k, f in fits.items()])
    trees = structure.centroid_row_clusters(scored, key, "scores", ks, min(leaves, scored.count()))
    labelled = keep(marked.join(trees.withColumnsRenamed({f"k{k}": f"tree_k{k}" for k in ks}), key))
    curves, agreements, tables = [], [], {}
    for method in ("kmeans", "tree"):
        quality = []
        for k in ks:
            column = f"{method}_k{k}"
            if exact_silhouette:
                row = neighbours.average_silhouette(labelled, key, "scores", column)
            else:
                value = neighbours.squared_silhouette(labelled, "scores", column)
                row = spark.createDataFrame([(float(value),)], "silhouette double")
            quality.append(row.select(F.lit(method).alias("method"), F.lit(k).alias("k"), "silhouette"))
        curve = keep(reduce(DataFrame.unionByName, quality))
        curves.append(curve)
        top = best_k(curve, "k", "silhouette").first()["best_k"]
        for k in sorted({structure.CLASS_COUNT, top} & set(ks)):
            column = f"{method}_k{k}"
            tables[f"crosstab_{column}"] = summaries.cross_table(labelled, column, y, classes)
            agreements.append(structure.agreement(labelled, column, y).select(
                F.lit(method).alias("method"), F.lit(k).alias("k"), F.lit(k == top).alias("is_best_k"), "*"))
    return tables | {
        "explained_variance": variance, "loadings": structure.loadings_table(spark, parts),
        "top_loadings": structure.top_loadings(structure.loadings_table(spark, parts)),
        "kmeans_curve": structure.inertia_table(spark, fits, scored.count()),
        "silhouette_curve": reduce(DataFrame.unionByName, curves), "agreement": reduce(DataFrame.unionByName, agreements),
        "clusters": labelled.drop("scores"),
    }
