"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.session import cut_lineage

MAX_SPLITS = 20  # splits counted side by side for each key


def _hash_key(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of the key; minus zero hashes like zero."""
    floats = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    parts = [F.col(f"`{k}`") + F.lit(0.0) if k in floats else F.col(f"`{k}`") for k in keys]
    gaps = [c.isNull() for c in parts]
    return [F.xxhash64(F.lit(seed), *parts, *gaps).alias(name) for seed, name in ((1, "_h1"), (2, "_h2"))]


def members_of(df: DataFrame, keys: Sequence[str], at_least: int = 2) -> DataFrame:
    """All rows whose key occurs at least ``at_least`` times; missing equals missing.

    Keys are counted by a 128-bit hash, combined before the shuffle, and the repeated hashes
    are written once. Rows meet them in a join of two tables read from storage, whose hot
    keys adaptive execution can split. Only rows with a repeated hash go on; should two
    different keys share a hash, those rows are counted again by the key itself.
    """
    on = ["_h1", "_h2"]
    marked = df.select("*", *_hash_key(df, keys))
    counts = marked.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= at_least)
    held = cut_lineage(marked.join(cut_lineage(counts.select(*on)), on, "left_semi"))
    whole = F.struct(*[F.col(f"`{k}`") for k in keys])
    mixed = cut_lineage(held.groupBy(*on).agg(F.min(whole).alias("_a"), F.max(whole).alias("_b")).filter(
        ~F.col("_a").eqNullSafe(F.col("_b"))).select(*on))
    if mixed.isEmpty():
        return held.drop(*on)
    names = [f"_k{i}" for i in range(len(keys))]
    unsure = held.join(mixed, on, "left_semi")
    again = unsure.groupBy(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]).agg(
        F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= at_least)
    same = reduce(lambda a, b: a & b, [unsure[f"`{k}`"].eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    sure = held.join(mixed, on, "left_anti")
    return sure.unionByName(unsure.join(cut_lineage(again), same, "left_semi")).drop(*on)


def excess_rows(df: DataFrame, keys: Sequence[str], split: str, name: str) -> DataFrame:
    """Rows beyond the first of each key, per split and over all splits ("total").

    Up to ``MAX_SPLITS`` splits are counted side by side for each key, so rows are shuffled once, by the key
    alone, and a repeated key is combined before the shuffle. More splits are counted as rows of their own
    and shuffled again for the total.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = df.select(F.col(split).alias("split"), *[F.col(k).alias(n) for k, n in zip(keys, names)])
    splits = [r[0] for r in rows.select("split").distinct().filter("split IS NOT NULL").limit(MAX_SPLITS + 1).collect()]
    if len(splits) <= MAX_SPLITS:
        per = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"), *[
            F.count(F.when(F.col("split") == s, 1)).alias(f"_n{i}") for i, s in enumerate(splits)])
        sums = [("total", "_n"), *[(s, f"_n{i}") for i, s in enumerate(splits)]]
        found = per.agg(*[(F.coalesce(F.sum(c), F.lit(0)) - F.count(F.when(F.col(c) > 0, 1))).alias(c) for _, c in sums])
        cells = [F.struct(F.lit(s).cast("string").alias("split"), F.col(c).alias(name)) for s, c in sums]
        return found.select(F.inline(F.array(*cells)))
    per = rows.groupBy("split", *names).agg(F.count(F.lit(1)).alias("_n"))
    by_split = per.groupBy("split").agg((F.sum("_n") - F.count(F.lit(1))).alias(name))
    overall = per.groupBy(*names).agg(F.sum("_n").alias("_n")).agg(
        F.lit("total").alias("split"), (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).alias(name)
    )
    return by_split.unionByName(overall)
