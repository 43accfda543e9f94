"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.llm.common import cut


ROWS_PER_FILE = 100_000


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
    return tuple(row)


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """node, root (the least node of its component) for every node that has a link.

    Large stars hang the greater neighbours of a node on its least neighbour, small stars do
    so with the smaller ones; repeated in turn they leave one star per component. Minima are
    combined before the shuffle and each round is written out, so a node with very many
    links is split by adaptive joins and no round depends on an executor's memory.
    """
    edges = cut(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).filter("u != v").distinct())
    before = _mark(edges)
    # Steps never add rows, so few links are written in few files whatever the shuffle setting.
    parts = 1 + before[0] // ROWS_PER_FILE

    def written(df: DataFrame) -> DataFrame:
        return cut(df.coalesce(parts))

    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter(
            "u != v").distinct()
        large = written(large)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct())
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return written(edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots))
