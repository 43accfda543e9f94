"""Ranks, running shares and first-best picks.

These windows have no partition key on purpose: they run over tables with one
row per feature, per component or per candidate k, never over data rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def competition_rank(score: Column, by: Sequence[Column] = ()) -> Column:
    """Descending rank where ties share the smallest position."""
    return F.rank().over(W.partitionBy(*by).orderBy(score.desc()))


def average_rank(score: Column, by: Sequence[Column] = ()) -> Column:
    """Descending rank where ties share the mean of their positions."""
    first = F.rank().over(W.partitionBy(*by).orderBy(score.desc()))
    ties = F.count(F.lit(1)).over(W.partitionBy(*by, score))
    return first + (ties - 1) / F.lit(2.0)


def percentile_rank(score: Column, by: Sequence[Column] = ()) -> Column:
    return average_rank(score, by) / F.count(F.lit(1)).over(W.partitionBy(*by))


def row_mean(columns: Sequence[Column]) -> Column:
    total = columns[0].cast("double")
    for c in columns[1:]:
        total = total + c
    return total / F.lit(float(len(columns)))


def running_total(value: Column, order: Column) -> Column:
    return F.sum(value).over(W.orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow))


def first_reaching(df: DataFrame, order: str, cumulative: str, threshold: float, name: str) -> DataFrame:
    """Smallest ``order`` whose cumulative value reaches the threshold."""
    return df.agg(F.min(F.when(F.col(cumulative) >= threshold, F.col(order))).alias(name))


def hartigan(inertia: Column, k: Column, n: Column) -> Column:
    """(W_k / W_{k+1} - 1)(n - k - 1); missing for the last k."""
    following = F.lead(inertia).over(W.orderBy(k))
    return (F.try_divide(inertia, following) - 1) * (n - k - 1)


def best_k(df: DataFrame, k: str, score: str, name: str = "best_k") -> DataFrame:
    """First k with the highest score."""
    return df.agg(F.max_by(F.col(k), F.struct(F.col(score), -F.col(k))).alias(name))


def top_n(df: DataFrame, order: Sequence[Column], n: int, by: Sequence[str] = (), rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per group under a total order, with their position."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
