"""Exact duplicates and repeated keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.functions.skew import members_of


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows in, distinct rows, and rows beyond the first of each copy group."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"), F.count(F.lit(1)).alias("rows_kept"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates_removed"),
    )


def without_duplicates(df: DataFrame) -> DataFrame:
    """One row per group of equal rows; missing equals missing."""
    return df.dropDuplicates()


def repeated_keys(df: DataFrame, key: Sequence[str], keep: Sequence[str | Column]) -> DataFrame:
    """Every row whose key occurs more than once; nothing is removed from the data."""
    return members_of(df, key).select(*keep)


def repeated_across_splits(
    train: DataFrame, test: DataFrame, key: Sequence[str], keep: Sequence[str | Column],
) -> DataFrame:
    """Repeats over the union of two splits; the split tag is not part of the key."""
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    return members_of(both, key).select(*keep)
