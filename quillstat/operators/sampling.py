"""Exact stratified splits and folds, and class weights.

Rows are ordered within a class by a salted hash of their key, so an assignment
depends on the key alone and not on partitioning, row order or lost executors. The
class sizes and the hash cut points are tiny and become literals: labelling rows is
one narrow pass without a shuffle. Rows that share a key always stay together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.functions.ordering import hash_cut_points, hash_histogram, key_hash

# Fixed values.
SEED = 42
TEST_SHARE = 0.20

ORDER_ROWS = 1_000_000

MAX_CLASSES = 10_000  # a column with more values is no class label; split and folds share this bound


def class_sizes(df: DataFrame, y: str) -> dict:
    rows = df.groupBy(F.col(y).alias("c")).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{y} has more than {MAX_CLASSES} values and is no class label")
    return {r["c"]: r["n"] for r in rows}


def split_quotas(sizes: dict, share: float = TEST_SHARE) -> dict:
    """Test rows per class: ceil(share * n) in all, by largest remainder."""
    n = sum(sizes.values())
    target = math.ceil(share * n)
    exact = {c: target * k / n for c, k in sizes.items()}
    quota = {c: math.floor(v) for c, v in exact.items()}
    by_rest = sorted(sizes, key=lambda c: (-round(exact[c] - quota[c], 12), c))
    for c in by_rest[: target - sum(quota.values())]:
        quota[c] += 1
    return quota


def _lookup(y: str, table: dict) -> Column:
    """Literal map from class to value; one entry per class."""
    cells = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*cells), F.col(y))


def with_split(
    df: DataFrame, y: str, keys: Sequence[str], share: float = TEST_SHARE, seed: int = SEED, name: str = "split",
    order_rows: int = ORDER_ROWS,
) -> DataFrame:
    """Mark every row "train" or "test" with exact class quotas.

    A bucket of more than ``order_rows`` rows is split further before it is ordered.
    """
    histogram = hash_histogram(df, y, keys, seed)
    quota = split_quotas({c: sum(b.values()) for c, b in histogram.items()}, share)
    cuts = hash_cut_points(df, y, keys, seed, histogram, {(c, 0): q for c, q in quota.items() if q > 0}, order_rows)
    if not cuts:
        return df.withColumn(name, F.lit("train"))
    edge = _lookup(y, {g: h for (g, _), h in cuts.items()})
    test = F.coalesce(key_hash(keys, seed) <= edge, F.lit(False))
    return df.withColumn(name, F.when(test, "test").otherwise("train"))


def with_folds(
    df: DataFrame, y: str, keys: Sequence[str], k: int, seed: int = SEED, name: str = "fold",
    only: Column | None = None, order_rows: int = ORDER_ROWS,
) -> DataFrame:
    """Mark every row with a fold 0..k-1; fold sizes differ by at most 1 per class.

    With ``only`` (say, the training rows) the other rows get fold -1. A row without a class
    has no fold (null).
    """
    pool = df if only is None else df.filter(only)
    histogram = hash_histogram(pool, y, keys, seed)
    sizes = {c: sum(b.values()) for c, b in histogram.items()}
    wanted = {(c, f): f * n // k for c, n in sizes.items() for f in range(1, k) if f * n // k > 0}
    cuts = hash_cut_points(pool, y, keys, seed, histogram, wanted, order_rows)
    h = key_hash(keys, seed)
    fold = F.lit(0)
    for f in range(1, k):
        edges = {g: cut for (g, i), cut in cuts.items() if i == f}
        if edges:
            # a class with no cut at f has fewer rows than folds
            passed = F.coalesce(h > _lookup(y, edges), F.lit(True))
            fold = fold + passed.cast("int")
        else:
            fold = fold + F.lit(1)
    fold = F.when(F.col(y).isNotNull(), fold)
    return df.withColumn(name, fold if only is None else F.when(only, fold).otherwise(F.lit(-1)))


def class_weights(df: DataFrame, y: str) -> dict:
    """Balanced weights n / (K * n_c); they sum to n over the rows."""
    sizes = class_sizes(df, y)
    n, k = sum(sizes.values()), len(sizes)
    return {c: n / (k * m) for c, m in sizes.items()}


def with_class_weight(df: DataFrame, y: str, weights: dict, name: str = "weight") -> DataFrame:
    return df.withColumn(name, _lookup(y, {c: float(w) for c, w in weights.items()}))
