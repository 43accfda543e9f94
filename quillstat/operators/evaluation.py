"""Metrics, reports, confusion tables and model comparison.

Predictions are counted into one (keys, truth, prediction) table with partial
aggregation; every metric is arithmetic on those few cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Fixed values.
PROBABILITY_FLOOR = 2.220446049250313e-16
CONFIDENCE_BINS = 15

METRICS = (
    "accuracy", "balanced_accuracy", "macro_precision", "macro_recall", "macro_f1",
    "weighted_precision", "weighted_recall", "weighted_f1",
)


def confusion_cells(df: DataFrame, y: str, pred: str, keys: Sequence[str] = ()) -> DataFrame:
    """Row counts per (keys, y, pred)."""
    return df.groupBy(*keys, F.col(y).alias("y"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))


def class_scores(cells: DataFrame, keys: Sequence[str] = (), classes: Sequence[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined.

    The classes are those in truth or prediction, or a fixed list if one is given. A missing
    label is one class like any other, on both sides.
    """
    none = F.lit(0).cast("long")
    hit = F.when(F.col("y").eqNullSafe(F.col("pred")), F.col("n")).otherwise(none)
    sides = F.inline(F.array(
        F.struct(F.col("y").alias("label"), F.col("n").alias("support"), hit.alias("hits"), none.alias("predicted")),
        F.struct(F.col("pred").alias("label"), none.alias("support"), none.alias("hits"), F.col("n").alias("predicted"))))
    on = [*keys, "label"]
    both = cells.select(*keys, sides).groupBy(*on).agg(
        *[F.sum(c).alias(c) for c in ("support", "hits", "predicted")])
    if classes is not None:
        spark = cells.sparkSession
        dim = spark.createDataFrame([(c,) for c in classes], "label string")
        groups = cells.select(*keys, F.explode(F.array(*[F.lit(c) for c in classes])).alias("label")).distinct()
        both = groups.join(both, on, "left").na.fill(0, ["support", "hits", "predicted"]) if keys else (
            dim.join(both, on, "left").na.fill(0, ["support", "hits", "predicted"]))
    precision = F.when(F.col("predicted") > 0, F.col("hits") / F.col("predicted")).otherwise(0.0)
    recall = F.when(F.col("support") > 0, F.col("hits") / F.col("support")).otherwise(0.0)
    f1 = F.when(F.col("support") + F.col("predicted") > 0, 2.0 * F.col("hits") / (F.col("support") + F.col("predicted")))
    return both.select(
        *on, precision.alias("precision"), recall.alias("recall"), f1.otherwise(0.0).alias("f1"), "support", "hits")


def metrics(df: DataFrame, y: str, pred: str, keys: Sequence[str] = (), classes: Sequence[str] | None = None) -> DataFrame:
    """The eight summary metrics per key."""
    return metrics_of(class_scores(confusion_cells(df, y, pred, keys), keys, classes), keys)


def metrics_of(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    total = F.sum("support")
    weighted = lambda c: (F.sum(F.col(c) * F.col("support")) / total).alias(f"weighted_{c}")
    return scores.groupBy(*keys).agg(
        (F.sum("hits") / total).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"),
        weighted("precision"), weighted("recall"), weighted("f1"),
    )


def classification_report(scores: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per-class rows, then accuracy, macro average and weighted average rows."""
    columns = [*keys, "label", "precision", "recall", "f1", "support", "score"]
    none = F.lit(None).cast("double")
    total = F.sum("support")
    each = scores.withColumn("score", none).select(*columns)
    averages = scores.groupBy(*keys).agg(
        total.alias("support"), (F.sum("hits") / total).alias("accuracy"),
        *[F.avg(c).alias(f"m_{c}") for c in ("precision", "recall", "f1")],
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(f"w_{c}") for c in ("precision", "recall", "f1")],
    )
    row = lambda label, p, r, f, s: F.struct(
        F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
        F.col("support"), s.alias("score"))
    extra = averages.select(*keys, F.inline(F.array(
        row("accuracy", none, none, none, F.col("accuracy")),
        row("macro avg", F.col("m_precision"), F.col("m_recall"), F.col("m_f1"), none),
        row("weighted avg", F.col("w_precision"), F.col("w_recall"), F.col("w_f1"), none),
    )))
    return each.unionByName(extra.select(*columns))


def confusion_matrix(
    df: DataFrame, y: str, pred: str, classes: Sequence[str], keys: Sequence[str] = (), normalise: str | None = None
) -> DataFrame:
    """One row per true class of the list, one column per predicted class.

    ``normalise`` divides by the row: "missing" leaves a class without rows empty,
    "zero" fills it with 0.
    """
    sums = [
        F.count(F.when((F.col(y) == a) & (F.col(pred) == b), 1)).alias(f"{i}_{j}")
        for i, a in enumerate(classes) for j, b in enumerate(classes)
    ]
    row = df.groupBy(*keys).agg(*sums)
    lines = [
        F.struct(F.lit(a).alias("true_class"), *[F.col(f"{i}_{j}").alias(b) for j, b in enumerate(classes)])
        for i, a in enumerate(classes)
    ]
    out = row.select(*keys, F.inline(F.array(*lines)))
    if normalise is None:
        return out
    size = sum((F.col(f"`{c}`") for c in classes), F.lit(0))
    empty = F.lit(0.0 if normalise == "zero" else None).cast("double")
    return out.select(
        *keys, "true_class", *[F.when(size > 0, F.col(f"`{c}`") / size).otherwise(empty).alias(c) for c in classes])


def log_loss(y: Column, probabilities: dict[str, Column]) -> Column:
    """Aggregate: mean negative log of the probability given to the true class."""
    total = sum(probabilities.values(), F.lit(0.0))
    given = F.lit(None).cast("double")
    for c, p in probabilities.items():
        given = F.when(y == c, p / total).otherwise(given)
    floor, ceiling = F.lit(PROBABILITY_FLOOR), F.lit(1.0 - PROBABILITY_FLOOR)
    return F.avg(-F.log(F.least(F.greatest(given, floor), ceiling)))


def with_confidence(df: DataFrame, y: str, pred: str, probabilities: Sequence[str]) -> DataFrame:
    return df.withColumns({"correct": F.col(y) == F.col(pred), "confidence": F.greatest(*probabilities)})


def confidence_histogram(df: DataFrame, bins: int = CONFIDENCE_BINS) -> DataFrame:
    from quillstat.operators.summaries import histogram

    return histogram(df, F.col("confidence"), bins, 0.0, 1.0, ["correct"])


def metrics_wide(long: DataFrame, names: Sequence[str] = METRICS, splits: Sequence[str] = ("train", "test")) -> DataFrame:
    """One row per model with ``train_`` and ``test_`` columns."""
    return long.groupBy("model").agg(*[
        F.max(F.when(F.col("split") == s, F.col(m))).alias(f"{s}_{m}") for s in splits for m in names])


def metrics_long(df: DataFrame, names: Sequence[str] = METRICS) -> DataFrame:
    return df.unpivot(["model", "split"], list(names), "metric", "value")


# --- choosing ------------------------------------------------------------------------

def choose_model(table: DataFrame, score: str = "macro_f1", split: str | None = None) -> DataFrame:
    """Best row: macro F1, then balanced accuracy, accuracy, fewest features, name.

    Pass the cross-validated table to choose without looking at test scores; pass
    ``split="test"`` for a choice by test scores.
    """
    pool = table.filter(F.col("split") == split) if split else table
    order = [F.desc(score)]
    order += [F.desc(c) for c in ("balanced_accuracy", "accuracy") if c in pool.columns]
    order += [F.asc("n_features")] if "n_features" in pool.columns else []
    return pool.orderBy(*order, F.asc("model")).limit(1)


def with_best_params(table: DataFrame, params: DataFrame) -> DataFrame:
    return table.join(params, "model", "left")


def comparison_order(table: DataFrame) -> DataFrame:
    """Test rows with their position by macro F1 and balanced accuracy."""
    order = W.orderBy(F.desc("macro_f1"), F.desc("balanced_accuracy"), F.asc("model"))  # one row per model
    return table.filter("split = 'test'").withColumn("position", F.row_number().over(order))
