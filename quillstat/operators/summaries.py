"""Class distributions, cross tables and histograms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillstat.operators.moments import feature_moments


def class_distribution(df: DataFrame, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Count and percent of total per class (and per slice)."""
    counts = df.groupBy(*keys, y).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(W.partitionBy(*keys))
    return counts.withColumn("percent", F.lit(100.0) * F.col("count") / total)


def class_distribution_full(df: DataFrame, y: str, split: str, display: Mapping[str, str]) -> DataFrame:
    """Counts over the canonical class list per split and "total"; absent classes are 0.

    ``proportion`` is missing where a split has no rows.
    """
    spark = df.sparkSession
    dim = spark.createDataFrame(
        [(c, d, i) for i, (c, d) in enumerate(display.items())],
        "class_raw string, class_display string, class_position int",
    )
    sizes = [F.count(F.when(F.col(y) == c, 1)).alias(f"_{i}") for i, c in enumerate(display)]
    wide = df.rollup(F.col(split).alias("split")).agg(*sizes).withColumn("split", F.coalesce("split", F.lit("total")))
    long = wide.unpivot(["split"], [f"_{i}" for i in range(len(display))], "slot", "count")
    total = F.sum("count").over(W.partitionBy("split"))
    return (
        long.withColumn("class_position", F.substring("slot", 2, 9).cast("int"))
        .join(F.broadcast(dim), "class_position")
        .select("split", "class_raw", "class_display", "count",
                F.when(total > 0, F.col("count") / total).alias("proportion"))
    )


def majority_class(df: DataFrame, y: str) -> DataFrame:
    """Most frequent class (first in order on a tie) and the accuracy of always saying it."""
    counts = df.groupBy(F.col(y).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by("c", F.struct(-F.col("n"), F.col("c")))
    return counts.agg(
        best.alias("majority_class"), F.max("n").alias("majority_count"),
        (F.max("n") / F.sum("n")).alias("majority_accuracy"),
    )


def cross_table(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts per row value with one column per listed value; empty cells are 0."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0, list(values))


def histogram(
    df: DataFrame, value: Column, bins: int, lo: float | None = None, hi: float | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Equal-width bin counts, last bin closed; range from the data unless given."""
    x = df.select(*keys, value.cast("double").alias("x")).filter(F.col("x").isNotNull())
    if lo is None or hi is None:
        ends = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).first()
        if ends["lo"] is None:
            return x.groupBy(*keys, F.lit(0).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        lo, hi = ends["lo"], ends["hi"]
    x = x.filter(F.col("x").between(lo, hi))
    if hi == lo:
        return x.groupBy(*keys, F.lit(bins // 2).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    slot = F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    return x.groupBy(*keys, slot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def contrast_of(moments: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per feature (in each group of ``by``), the largest gap between a class mean and the overall mean, from moments per class."""
    over = W.partitionBy(*by, "feature")  # one row per class
    weighted = F.when(F.col("n") > 0, F.col("n") * F.col("mean"))
    gap = F.abs(F.col("mean") - F.try_divide(F.sum(weighted).over(over), F.sum("n").over(over)))
    return moments.select(*by, "feature", gap.alias("g")).groupBy(*by, "feature").agg(F.max("g").alias("class_mean_contrast"))


def class_mean_contrast(df: DataFrame, y: str, features: Sequence[str]) -> DataFrame:
    """``contrast_of`` for wide rows, which are not unpivoted."""
    return contrast_of(feature_moments(df, [y], features))
