"""Complete-linkage clustering of a bounded set of nodes.

Nodes are features, or as many centres of a k-means over the rows as the caller asks for.
The driver holds one entry per node. The pair table lives in Spark. Each round merges every pair of clusters
that are each other's nearest, which for complete linkage gives the same tree as
merging one pair at a time, in about log(n) rounds; the distance of a merged cluster
is the largest distance between its parts.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.operators.collinearity import CLUSTER_DISTANCE, with_cluster_size
from quillstat.session import cut_lineage

_MERGES = "step int, a int, b int, height double, size int"


def complete_linkage(pairs: DataFrame, n: int) -> DataFrame:
    """Merges (step, a, b, height, size) over nodes 0..n-1 from all (i, j, d), i < j.

    ``a`` < ``b`` are the smallest members of the merged clusters; the new cluster
    is known by ``a`` from then on.
    """
    spark = pairs.sparkSession
    base = cut_lineage(pairs.select("i", "j", "d"))
    cluster = list(range(n))
    sizes = dict.fromkeys(range(n), 1)
    merges: list[tuple] = []
    while len(merges) < n - 1:
        found = _mutual_nearest(_between_clusters(base, cluster) if merges else base)
        if not found:
            raise ValueError("the pair table does not join all nodes")
        joined = {b: a for a, b, _ in found}
        cluster = [joined.get(c, c) for c in cluster]
        for a, b, d in sorted(found, key=lambda m: (m[2], m[0], m[1])):
            sizes[a] += sizes.pop(b)
            merges.append((a, b, float(d), sizes[a]))
    merges.sort(key=lambda m: m[2])  # stable: a merge never precedes its parts
    rows = [(s, *m) for s, m in enumerate(merges)]
    return spark.createDataFrame(rows, _MERGES)


def _between_clusters(base: DataFrame, cluster: list[int]) -> DataFrame:
    """Largest node distance between every two current clusters."""
    table = pd.DataFrame({"node": range(len(cluster)), "c": cluster})
    names = base.sparkSession.createDataFrame(table, "node int, c int")
    of = lambda end, name: F.broadcast(names.select(F.col("node").alias(end), F.col("c").alias(name)))
    moved = base.join(of("i", "p"), "i").join(of("j", "q"), "j").filter("p <> q")
    return moved.groupBy(F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j")).agg(F.max("d").alias("d"))


def _mutual_nearest(live: DataFrame) -> list[tuple]:
    """Pairs of clusters that are each other's nearest; ties by smaller members."""
    ends = live.select(F.explode(F.array(
        F.struct(F.col("i").alias("node"), F.col("d"), F.col("i"), F.col("j")),
        F.struct(F.col("j").alias("node"), F.col("d"), F.col("i"), F.col("j")),
    )).alias("e")).select("e.*")
    nearest = ends.groupBy("node").agg(F.min(F.struct("d", "i", "j")).alias("m"))
    votes: dict[tuple, int] = {}
    for r in nearest.select("m.i", "m.j", "m.d").collect():  # one row per cluster
        pair = (r["i"], r["j"], r["d"])
        votes[pair] = votes.get(pair, 0) + 1
    return [pair for pair, n in votes.items() if n == 2]


def cut_tree(
    merges: DataFrame, n: int, height: float | None = None, clusters: int | None = None
) -> DataFrame:
    """Cluster of every node, (node, cluster_id), after merges up to a height or down
    to a number of clusters. Ids count from 1 in the order of smallest members."""
    rows = merges.orderBy("step").collect()  # one row per node
    keep = [r for r in rows if r["height"] <= height] if height is not None else rows[: max(n - (clusters or 1), 0)]
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for r in keep:
        a, b = root(r["a"]), root(r["b"])
        parent[max(a, b)] = min(a, b)
    roots = [root(x) for x in range(n)]
    number = {r: i + 1 for i, r in enumerate(sorted(set(roots)))}
    table = pd.DataFrame({"node": range(n), "cluster_id": [number[r] for r in roots]})
    return merges.sparkSession.createDataFrame(table, "node int, cluster_id int")


def correlation_distances(pairs: DataFrame, features: Sequence[str]) -> DataFrame:
    """(i, j, d) with d = 1 - |r| from named pairs."""
    dim = pairs.sparkSession.createDataFrame(list(enumerate(features)), "position int, feature string")
    first = F.broadcast(dim.select(F.col("feature").alias("feature_1"), F.col("position").alias("i")))
    second = F.broadcast(dim.select(F.col("feature").alias("feature_2"), F.col("position").alias("j")))
    return pairs.join(first, "feature_1").join(second, "feature_2").select(
        "i", "j", (1.0 - F.coalesce("abs_correlation", F.lit(0.0))).alias("d"))


def feature_clusters(pairs: DataFrame, features: Sequence[str], height: float = CLUSTER_DISTANCE) -> DataFrame:
    """Clusters in which every two features correlate at least 1 - height."""
    merges = complete_linkage(correlation_distances(pairs, features), len(features))
    labels = cut_tree(merges, len(features), height=height)
    dim = pairs.sparkSession.createDataFrame(list(enumerate(features)), "node int, feature string")
    return with_cluster_size(dim.join(labels, "node").select("feature", "cluster_id"))
