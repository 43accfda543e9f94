"""Distance work over all pairs of two row sets: nearest neighbours and silhouette.

Both need every distance, so the work is a grid: rows are hashed into even strips of
blocks, each cell of the grid meets one strip of either side, block by block, and a cell
passes on only what its rows need (k candidates, or one sum per cluster), never its pairs.
A side has about the root of its blocks in strips, so a row is copied that often and not
once per block; a cell holds at most two strips of ``STRIP_ROWS`` rows, whatever the number
of rows or the size of a class or cluster.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillstat.session import cut_lineage, keep

# Fixed values.
NEIGHBOURS = 5

BLOCK_ROWS = 4_000
STRIP_ROWS = 48_000
LEAST_STRIPS = 4
_CHUNK_CELLS = 4_000_000
_NEAR = 1e-6  # share of the squared sizes under which a product form of a distance has lost digits
_DOUBT = 1e-11  # the same for its own error, with room to spare


def _block(key: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(blocks)).cast("int")


def _every(blocks: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def _strips(df: DataFrame, rows: int) -> int:
    n = df.count()
    blocks = max(1, math.ceil(n / rows))
    return max(math.isqrt(blocks - 1) + 1, min(blocks, LEAST_STRIPS), math.ceil(n / max(rows, STRIP_ROWS)))


def _slices(a: np.ndarray, b: np.ndarray, rows: int):
    """Yield (start in a, start in b, squared distances, their sizes) for blocks of both, by one product each."""
    shift = b.mean(axis=0)
    a, b = a - shift, b - shift
    sa, sb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    step = max(1, _CHUNK_CELLS // min(rows, len(b)))
    for at in range(0, len(a), step):
        for to in range(0, len(b), rows):
            size = sa[at : at + step, None] + sb[None, to : to + rows]
            yield at, to, np.maximum(size - 2.0 * (a[at : at + step] @ b[to : to + rows].T), 0.0), size


def _gaps(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the pairs (a[i], b[j]) from their differences."""
    out = np.empty(len(i))
    step = max(1, _CHUNK_CELLS // max(1, a.shape[1]))
    for at in range(0, len(i), step):
        gap = a[i[at : at + step]] - b[j[at : at + step]]
        out[at : at + step] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    return out


def _nearest(a: np.ndarray, b: np.ndarray, k: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, distance) of the k nearest b of every a; on equal distances those that come first in b.

    Products only rule pairs out; what is left is measured by differences."""
    out, bound = [], np.full(len(a), np.inf)
    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
    for at, to, square, size in _slices(a, b, rows):
        if to == 0:
            out.append(held)
            held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        end, room = at + len(square), _DOUBT * size.max()
        if square.shape[1] >= k:
            bound[at:end] = np.minimum(bound[at:end], np.partition(square, k - 1, axis=1)[:, k - 1] + room)
        i, j = np.nonzero(square <= bound[at:end, None] + room)
        i, j = i + at, j + to
        i, j, d = (np.concatenate(v) for v in zip(held, (i, j, _gaps(a, b, i, j))))
        order = np.lexsort((j, d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.arange(len(i)) - np.searchsorted(i, i, side="left") < k
        held = [i[first], j[first], d[first]]
    return tuple(np.concatenate(v) for v in zip(*out, held))


def _distances(a: np.ndarray, b: np.ndarray):
    """Yield (start, distances) for slices of ``a`` against all of ``b``."""
    step = max(1, _CHUNK_CELLS // max(1, b.shape[0] * b.shape[1]))
    for at in range(0, len(a), step):
        gap = a[at : at + step, None, :] - b[None, :, :]
        yield at, np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))


def nearest_neighbours(
    queries: DataFrame, base: DataFrame, key: str, vector: str, carry: str, k: int = NEIGHBOURS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k nearest base rows of each query row: (key, neighbour, carry, distance, rank).

    Equal distances are ordered by the neighbour's key.
    """
    nq, nb = _strips(queries, block_rows), _strips(base, block_rows)
    left = queries.select(
        F.col(key).alias("q"), F.col(vector).cast("array<double>").alias("x"), _block(key, nq).alias("row"), _every(nb).alias("column"))
    right = base.select(
        F.col(key).alias("b"), F.col(vector).cast("array<double>").alias("v"), F.col(carry).alias("carry"),
        _every(nq).alias("row"), _block(key, nb).alias("column"))
    q_type, b_type, carry_type = (
        df.schema[name].dataType.simpleString() for df, name in ((queries, key), (base, key), (base, carry)))

    def nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"q": [], "b": [], "carry": [], "distance": []}, dtype=object)  # becomes any type
        b = b.sort_values("b", kind="stable")
        i, j, d = _nearest(np.stack(a["x"].to_numpy()), np.stack(b["v"].to_numpy()), k, block_rows)
        return pd.DataFrame({
            "q": a["q"].to_numpy()[i], "b": b["b"].to_numpy()[j], "carry": b["carry"].to_numpy()[j], "distance": d})

    cells = left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInPandas(
        nearest, f"q {q_type}, b {b_type}, carry {carry_type}, distance double")
    order = W.partitionBy("q").orderBy("distance", "b")  # k rows per strip of the base
    best = cells.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select(F.col("q").alias(key), F.col("b").alias("neighbour"), F.col("carry").alias(carry), "distance", "rank")


MOST_PIVOTS = 1_024
PROBED = 256
DENSE = 0.2  # of all pairs; from there on cells cost more than they save
_SLACK = 1e-9  # relative; a bound must not lose a tie to rounding


def nearest_by_cells(
    queries: DataFrame, base: DataFrame, key: str, vector: str, carry: str, k: int = NEIGHBOURS,
    block_rows: int = BLOCK_ROWS, pivots: int | None = None, report: dict | None = None,
) -> DataFrame:
    """``nearest_neighbours`` without comparing every pair; the same rows. Keys of ``base`` are unique.

    Base rows belong to the nearest of some pivots (rows picked by hash; about the root of the rows, ``MOST_PIVOTS`` at
    most). A query first meets the nearest cells that hold k rows, which bounds its k-th distance. From then on a cell is
    skipped if the triangle inequality rules it out: by the cell's radius, and because its rows are nearer to its pivot
    than to the query's own nearest one. Cells and the queries of a cell are split into blocks, so a task holds two blocks
    however many rows are alike. Where the bounds leave more than ``DENSE`` of the pairs to a few probed queries, as in many
    dimensions, the grid of ``nearest_neighbours`` answers instead. ``report`` gets the pairs compared and all pairs, and
    keeps to the cells.
    """
    n = base.count()
    points = base.select(F.col(key).alias("b"), F.col(vector).cast("array<double>").alias("v"), F.col(carry).alias("carry"))
    asked = queries.select(F.col(key).alias("q"), F.col(vector).cast("array<double>").alias("x"))
    wanted = pivots or max(1, min(MOST_PIVOTS, math.isqrt(n)))
    marks = np.array([r["v"] for r in points.orderBy(F.xxhash64("b"), "b").limit(wanted).collect()])
    if not len(marks):
        return nearest_neighbours(queries, base, key, vector, carry, k, block_rows)

    @F.pandas_udf("cell int, away double")
    def place(v: pd.Series) -> pd.DataFrame:
        if v.empty:
            return pd.DataFrame({"cell": np.zeros(0, np.int32), "away": np.zeros(0)})
        parts = [(d.argmin(axis=1), d.min(axis=1)) for _, d in _distances(np.stack(v.to_numpy()), marks)]
        return pd.DataFrame({"cell": np.concatenate([c for c, _ in parts]).astype(np.int32), "away": np.concatenate([a for _, a in parts])})

    placed = keep(points.withColumn("p", place("v")).select("b", "v", "p.cell", "p.away"))
    sizes, radius = np.zeros(len(marks), np.int64), np.zeros(len(marks))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect():  # one row a cell
        sizes[r["cell"]], radius[r["cell"]] = r["n"], r["r"]

    @F.pandas_udf("array<int>")
    def home(x: pd.Series) -> pd.Series:
        out = []
        for _, d in _distances(np.stack(x.to_numpy()) if len(x) else np.zeros((0, marks.shape[1])), marks):
            order = np.argsort(np.where(sizes > 0, d, np.inf), axis=1, kind="stable")
            enough = (np.cumsum(sizes[order], axis=1) < k).sum(axis=1) + 1
            out += [row[:e].tolist() for row, e in zip(order, enough)]
        return pd.Series(out, dtype=object)

    @F.pandas_udf("array<int>")
    def others(x: pd.Series, limit: pd.Series, done: pd.Series) -> pd.Series:
        out, at_most = [], limit.to_numpy()
        for at, d in _distances(np.stack(x.to_numpy()) if len(x) else np.zeros((0, marks.shape[1])), marks):
            reach = at_most[at : at + len(d), None]
            least = np.maximum(d - radius, (d - d.min(axis=1, keepdims=True)) / 2)
            open_ = (least <= reach + _SLACK * (d + reach)) & (sizes > 0)
            for row, seen in zip(open_, done.iloc[at : at + len(d)]):
                row[np.asarray(seen, dtype=int)] = False
                out.append(np.flatnonzero(row).tolist())
        return pd.Series(out, dtype=object)

    q_type, b_type = queries.schema[key].dataType.simpleString(), base.schema[key].dataType.simpleString()
    number = lambda values: F.array(*[F.lit(int(v)) for v in values])
    base_blocks = np.maximum(1, -(-sizes // block_rows))

    def nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"q": [], "b": [], "distance": []}, dtype=object)
        b = b.sort_values("b", kind="stable")
        i, j, d = _nearest(np.stack(a["x"].to_numpy()), np.stack(b["v"].to_numpy()), k, block_rows)
        return pd.DataFrame({"q": a["q"].to_numpy()[i], "b": b["b"].to_numpy()[j], "distance": d})

    def met(pairs: DataFrame) -> DataFrame:
        """The k nearest rows of every block that the cells in (q, x, cell) have."""
        count = np.zeros(len(marks), np.int64)
        for r in pairs.groupBy("cell").count().collect():
            count[r["cell"]] = r["count"]
        if report is not None:
            report["pairs"] = report.get("pairs", 0) + int(count @ sizes)
        parts = np.maximum(1, -(-count // block_rows))
        left = pairs.withColumn("part", F.pmod(F.xxhash64("q"), number(parts)[F.col("cell")]).cast("int")).withColumn(
            "block", F.explode(F.sequence(F.lit(0), number(base_blocks)[F.col("cell")] - 1)))
        right = placed.withColumn("block", F.pmod(F.xxhash64("b"), number(base_blocks)[F.col("cell")]).cast("int")).withColumn(
            "part", F.explode(F.sequence(F.lit(0), number(parts)[F.col("cell")] - 1)))
        by = ["cell", "block", "part"]
        return left.groupBy(*by).cogroup(right.select("b", "v", *by).groupBy(*by)).applyInPandas(
            nearest, f"q {q_type}, b {b_type}, distance double")

    def best(rows: DataFrame) -> DataFrame:
        order = W.partitionBy("q").orderBy("distance", "b")  # k rows for each block met
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    begun = keep(asked.withColumn("done", home("x")))
    first = cut_lineage(best(met(begun.select("q", "x", F.explode("done").alias("cell")))).drop("rank"))
    limits = first.groupBy("q").agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).otherwise(float("inf")).alias("limit"))
    if report is None:
        # What the bounds leave to some hundred queries tells which exact way is the cheaper one.
        some = begun.orderBy(F.xxhash64("q"), "q").limit(PROBED).join(limits, "q").select(others("x", "limit", "done").alias("c"))
        left_open = [int(sizes[r["c"]].sum()) for r in some.collect()]
        if sum(left_open) > DENSE * n * len(left_open):
            for table in (placed, begun):
                table.unpersist()
            return nearest_neighbours(queries, base, key, vector, carry, k, block_rows)
    more = keep(begun.join(limits, "q").withColumn("cell", F.explode(others("x", "limit", "done"))).select("q", "x", "cell"))
    out = cut_lineage(best(first.unionByName(met(more))))
    for table in (placed, begun, more):
        table.unpersist()
    if report is not None:
        report["all_pairs"] = n * asked.count()
    return out.join(points.select("b", "carry"), "b").select(
        F.col("q").alias(key), F.col("b").alias("neighbour"), F.col("carry").alias(carry), "distance", "rank")


def neighbour_votes(found: DataFrame, key: str, label: str) -> DataFrame:
    """Weight and share per (key, label): 1/distance, or only the exact matches if any."""
    exact = F.max((F.col("distance") == 0).cast("int")).over(W.partitionBy(key))  # k rows
    weight = F.when(exact == 1, (F.col("distance") == 0).cast("double")).otherwise(F.lit(1.0) / F.col("distance"))
    votes = found.withColumn("w", weight).groupBy(key, label).agg(F.sum("w").alias("w"))
    return votes.withColumn("share", F.col("w") / F.sum("w").over(W.partitionBy(key))).drop("w")


def knn_predict(
    queries: DataFrame, base: DataFrame, key: str, vector: str, label: str, k: int = NEIGHBOURS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(key, pred, confidence): the label with the largest share, first in order on a tie."""
    return predicted_labels(nearest_by_cells(queries, base, key, vector, label, k, block_rows), key, label)


def nearest_of_parts(found: DataFrame, key: str, k: int = NEIGHBOURS) -> DataFrame:
    """The k nearest rows of a base from the k nearest of each of its parts."""
    order = W.partitionBy(key).orderBy("distance", "neighbour")  # k rows a part
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def predicted_labels(found: DataFrame, key: str, label: str) -> DataFrame:
    """(key, pred, confidence) of the neighbours found for each key."""
    votes = neighbour_votes(found, key, label)
    best = F.min_by(F.col(label), F.struct(-F.round("share", 12), F.col(label)))
    return votes.groupBy(key).agg(best.alias("pred"), F.max("share").alias("confidence"))


# --- silhouette ----------------------------------------------------------------------

def silhouette_rows(
    df: DataFrame, key: str, vector: str, cluster: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Silhouette of every row: (b - a) / max(a, b), 0 for a row alone in its cluster.

    ``a`` is the mean distance to the other rows of the own cluster and ``b`` the
    smallest mean distance to another cluster.
    """
    blocks = _strips(df, block_rows)
    rows = df.select(F.col(key).alias("q"), F.col(vector).cast("array<double>").alias("x"), F.col(cluster).alias("c"))
    left = rows.select("*", _block("q", blocks).alias("row"), _every(blocks).alias("column"))
    right = rows.select(
        F.col("x").alias("v"), F.col("c").alias("other"), _every(blocks).alias("row"), _block("q", blocks).alias("column"))
    q_type, c_type = df.schema[key].dataType.simpleString(), df.schema[cluster].dataType.simpleString()

    def sums(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"q": [], "c": [], "other": [], "s": []})
        names, code = np.unique(b["other"].to_numpy(), return_inverse=True)
        member = np.eye(len(names))[code]
        x, v = np.stack(a["x"].to_numpy()), np.stack(b["v"].to_numpy())
        total = np.zeros((len(x), len(names)))
        for at, to, square, size in _slices(x, v, block_rows):
            d = np.sqrt(square)
            i, j = np.nonzero(square <= _NEAR * size)
            d[i, j] = _gaps(x, v, i + at, j + to)
            total[at : at + len(d)] += d @ member[to : to + block_rows]
        return pd.DataFrame({
            "q": np.repeat(a["q"].to_numpy(), len(names)), "c": np.repeat(a["c"].to_numpy(), len(names)),
            "other": np.tile(names, len(x)), "s": total.ravel()})

    cells = left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInPandas(
        sums, f"q {q_type}, c {c_type}, other {c_type}, s double")
    sizes = F.broadcast(rows.groupBy(F.col("c").alias("other")).agg(F.count(F.lit(1)).alias("n")))
    means = cells.groupBy("q", "c", "other").agg(F.sum("s").alias("s")).join(sizes, "other")
    own = F.col("c") == F.col("other")
    per = means.groupBy("q", "c").agg(
        F.max(F.when(own, F.col("n"))).alias("n"), F.max(F.when(own, F.try_divide(F.col("s"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("s") / F.col("n"))).alias("b"),
    )
    score = F.when(F.col("n") > 1, F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    return per.select(F.col("q").alias(key), F.col("c").alias(cluster), score.otherwise(0.0).alias("silhouette"))


def average_silhouette(df: DataFrame, key: str, vector: str, cluster: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    return silhouette_rows(df, key, vector, cluster, block_rows).agg(F.avg("silhouette").alias("silhouette"))


def squared_silhouette(df: DataFrame, vector: str, cluster: str) -> float:
    """Silhouette on squared distances, which needs only cluster sums: linear in rows."""
    table = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features"),
                      F.col(cluster).cast("int").alias("prediction"))
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(table)
