"""Which coefficients are zero: by model, class and feature, and across models.

Inputs are long coefficient tables (model, class, feature, coefficient).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.functions.ranking import top_n
from quillstat.functions.scalars import NEAR_ZERO, is_nonzero, selection_status

TOP_COEFFICIENTS = 30


def with_flags(coefs: DataFrame, tol: float = NEAR_ZERO) -> DataFrame:
    return coefs.withColumns(
        {"abs_coefficient": F.abs("coefficient"), "is_nonzero": is_nonzero(F.col("coefficient"), tol)})


def _active() -> Column:
    return F.count(F.when(F.col("is_nonzero"), 1))


def by_feature(coefs: DataFrame) -> DataFrame:
    """Per model and feature: any nonzero, active classes, largest and summed size."""
    return coefs.groupBy("model", "feature").agg(
        F.max("is_nonzero").alias("selected"), _active().alias("n_active_classes"),
        F.max("abs_coefficient").alias("max_abs_coefficient"), F.sum("abs_coefficient").alias("sum_abs_coefficient"),
    )


def by_model(coefs: DataFrame) -> DataFrame:
    n, k = F.count(F.lit(1)), _active()
    cells = coefs.groupBy("model").agg(
        n.alias("total_coefficients"), (n - k).alias("zero_coefficients"), k.alias("nonzero_coefficients"),
        ((n - k) / n).alias("zero_share"), (k / n).alias("nonzero_share"),
    )
    p, a = F.count(F.lit(1)), F.count(F.when(F.col("selected"), 1))
    features = by_feature(coefs).groupBy("model").agg(
        p.alias("total_features"), a.alias("active_features"), (p - a).alias("inactive_features"),
        (a / p).alias("active_feature_share"),
    )
    return cells.join(features, "model")


def by_class(coefs: DataFrame, label: str = "class") -> DataFrame:
    n, k = F.count(F.lit(1)), _active()
    return coefs.groupBy("model", label).agg(
        n.alias("total_coefficients"), (n - k).alias("zero_coefficients"), k.alias("nonzero_coefficients"),
        ((n - k) / n).alias("zero_share"), (k / n).alias("nonzero_share"),
        F.max("abs_coefficient").alias("max_abs_coefficient"),
    )


def wide_summary(coefs: DataFrame, label: str = "class") -> DataFrame:
    """The wide variant: percent sparsity over coefficients and over features."""
    per = coefs.groupBy("model", "feature").agg(
        F.count(F.lit(1)).alias("k"), _active().alias("a"))
    n, a = F.sum("k"), F.sum("a")
    p, q = F.count(F.lit(1)), F.count(F.when(F.col("a") > 0, 1))
    return per.groupBy("model").agg(
        p.alias("n_features_input_after_screening"), F.max("k").alias("n_classes"), n.alias("n_coefficients_total"),
        a.alias("n_nonzero_coefficients"), (F.lit(100.0) * (F.lit(1.0) - a / n)).alias("coefficient_sparsity_pct"),
        q.alias("n_active_features"), (F.lit(100.0) * (F.lit(1.0) - q / p)).alias("feature_sparsity_pct"),
    )


def active_by_class(coefs: DataFrame, label: str = "class") -> DataFrame:
    return coefs.filter("is_nonzero").select("model", label, "feature", "coefficient", "abs_coefficient")


def selection_table(coefs: DataFrame, a: str, b: str) -> DataFrame:
    """Per feature: selected by either model, and which of the four cases holds."""
    chosen = by_feature(coefs)
    left = chosen.filter(F.col("model") == a).select("feature", F.col("selected").alias(f"selected_{a}"))
    right = chosen.filter(F.col("model") == b).select("feature", F.col("selected").alias(f"selected_{b}"))
    both = left.join(right, "feature", "full_outer").na.fill(False)
    return both.withColumn(
        "selection_status", selection_status(F.col(f"selected_{a}"), F.col(f"selected_{b}"), a, b))


def selection_counts(table: DataFrame) -> DataFrame:
    """Features per case, with the sorted names (p names in all)."""
    return table.groupBy("selection_status").agg(
        F.count(F.lit(1)).alias("n_features"), F.array_sort(F.collect_list("feature")).alias("features"))


def coefficient_matrix(coefs: DataFrame, classes: Sequence[str], label: str = "class", active_only: bool = False) -> DataFrame:
    """One row per model and feature, one column per class, 0 where absent."""
    grid = coefs.groupBy("model", "feature").pivot(label, list(classes)).agg(F.first("coefficient"))
    grid = grid.na.fill(0.0, list(classes))
    grid = grid.withColumn("max_abs_coefficient", F.greatest(*[F.abs(F.col(f"`{c}`")) for c in classes]))
    return grid.filter(is_nonzero(F.col("max_abs_coefficient"))) if active_only else grid


def top_coefficients(coefs: DataFrame, n: int = TOP_COEFFICIENTS, label: str = "class") -> DataFrame:
    order = [F.desc("abs_coefficient"), F.asc("model"), F.asc(label), F.asc("feature")]
    return coefs.orderBy(*order).limit(n)


def top_by_class(coefs: DataFrame, n: int = TOP_COEFFICIENTS, label: str = "class") -> DataFrame:
    return top_n(coefs, [F.desc("abs_coefficient"), F.asc("feature")], n, ["model", label])


def extremes_by_class(coefs: DataFrame, n: int = 10, label: str = "class") -> DataFrame:
    """The n largest and n smallest signed coefficients of each class."""
    up = top_n(coefs, [F.desc("coefficient"), F.asc("feature")], n, ["model", label])
    down = top_n(coefs, [F.asc("coefficient"), F.asc("feature")], n, ["model", label])
    return up.withColumn("direction", F.lit("positive")).unionByName(down.withColumn("direction", F.lit("negative")))


def active_features(coefs: DataFrame, model: str) -> DataFrame:
    return by_feature(coefs).filter((F.col("model") == model) & F.col("selected")).select("feature")


def selected_union(coefs: DataFrame, order: DataFrame, all_if_none: bool = True) -> DataFrame:
    """Features active in any model with their position in ``order``; when none is, all of them or no row."""
    hit = by_feature(coefs).groupBy("feature").agg(F.max("selected").alias("selected"))
    marked = order.join(hit, "feature", "left").withColumn("selected", F.coalesce("selected", F.lit(False)))
    if not all_if_none:
        return marked.filter("selected").select("feature", "position")
    any_hit = marked.agg(F.max("selected").alias("any")).first()["any"]
    return (marked.filter("selected") if any_hit else marked).select("feature", "position")
