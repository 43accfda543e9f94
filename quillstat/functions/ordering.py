"""Order statistics over data rows that never sort a whole group in one task.

Hash-ordered cut points: rows of a class are put in the order of a salted md5 of
their key. A short hash prefix splits every class into even buckets, so bucket counts
alone locate the bucket that holds a wanted rank, and only that bucket's rows are
looked at again. One class may hold any share of the table.

Exact quantiles: a bracket around the wanted rank shrinks by approximate quantiles
until the values left inside are few enough to order exactly.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PREFIX_DIGITS = 2  # 256 buckets per class and pass
MAX_BUCKETS = 10_000 * 16**PREFIX_DIGITS  # all buckets of as many classes as a label may have


def key_hash(keys: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def hash_histogram(df: DataFrame, group: str, keys: Sequence[str], seed: int) -> dict:
    """Rows per class and hash prefix, {class: {prefix: rows}}: one small aggregate.

    Every task adds at most 256 rows per class to the shuffle, so the cost does not
    grow with the data beyond the scan.
    """
    prefix = F.substring(key_hash(keys, seed), 1, PREFIX_DIGITS)
    counts = df.filter(F.col(group).isNotNull()).groupBy(F.col(group).alias("g"), prefix.alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    return _bucket_counts(counts, ["g"])


def _bucket_counts(counts: DataFrame, by: Sequence[str]) -> dict:
    rows = counts.limit(MAX_BUCKETS + 1).collect()
    if len(rows) > MAX_BUCKETS:
        raise ValueError("too many classes for exact cut points")
    out: dict = {}
    for r in rows:
        key = r[by[0]] if len(by) == 1 else tuple(r[b] for b in by)
        out.setdefault(key, {})[r["b"]] = r["n"]
    return out


def hash_cut_points(
    df: DataFrame, group: str, keys: Sequence[str], seed: int, histogram: dict, wanted: dict, order_rows: int = 1_000_000
) -> dict:
    """The hash at each wanted rank, {(class, cut): hash}, for ``wanted`` ranks from 1.

    The bucket that holds a rank is split by two more hash digits per pass until it
    is small enough to be ordered; only its rows are read on.
    """
    spans = {(g, cut): _enter(histogram[g], rank) for (g, cut), rank in wanted.items()}
    if not spans:
        return {}
    rows = df.select(F.col(group).alias("g"), key_hash(keys, seed).alias("h"))
    g_type = df.schema[group].dataType.simpleString()
    digits = PREFIX_DIGITS
    while any(n > order_rows for _, _, n in spans.values()) and digits < 32:
        held = _in_buckets(rows, spans, digits, g_type)
        digits += PREFIX_DIGITS
        finer = held.groupBy("g", "cut", F.substring("h", 1, digits).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        parts = _bucket_counts(finer, ["g", "cut"])
        spans = {key: _enter(parts[key], span[1]) for key, span in spans.items()}
    ranked = _in_buckets(rows, spans, digits, g_type).withColumn(
        "k", F.row_number().over(W.partitionBy("g", "cut").orderBy("h")))
    return {(r["g"], r["cut"]): r["h"] for r in ranked.filter(F.col("k") == F.col("r")).collect()}


def _enter(buckets: dict, rank: int) -> tuple[str, int, int]:
    """(prefix, rank inside it, its rows) of the bucket that holds a rank."""
    for prefix in sorted(buckets):
        if rank <= buckets[prefix]:
            return prefix, rank, buckets[prefix]
        rank -= buckets[prefix]
    raise ValueError("the rank exceeds the class size")


def _in_buckets(rows: DataFrame, spans: dict, digits: int, g_type: str) -> DataFrame:
    table = rows.sparkSession.createDataFrame(
        [(g, cut, prefix, r) for (g, cut), (prefix, r, _) in spans.items()], f"g {g_type}, cut int, b string, r long")
    return rows.withColumn("b", F.substring("h", 1, digits)).join(F.broadcast(table), ["g", "b"])


def exact_quantiles(
    long: DataFrame, q: float = 0.5, feature: str = "feature", value: str = "value", order_rows: int = 1_000_000
) -> dict[str, float | None]:
    """Interpolated quantile per feature of a long (feature, value) table.

    A feature with at most ``order_rows`` values is settled by one aggregate. Any
    other keeps, per wanted rank, an open interval that holds it. Counts of an even
    grid between its least and greatest value shrink it first, which is enough unless
    most values crowd in one cell. Each further round probes the interval with
    approximate quantiles, counts rows around the probes and keeps the part with the
    rank; a cell or probe that holds nothing but the rank's own run of equal
    values settles it, so one value may hold any share of the rows.
    """
    spark = long.sparkSession
    rows = long.select(F.col(feature).alias("f"), F.col(value).cast("double").alias("v"))
    present = F.col("v").isNotNull() & ~F.isnan("v")
    held = F.when(present, F.col("v"))
    ends = {r["f"]: (r["n"], r["lo"], r["hi"]) for r in rows.groupBy("f").agg(
        F.count(held).alias("n"), F.min(held).alias("lo"), F.max(held).alias("hi")).collect()}
    sizes = {f: n for f, (n, _, _) in ends.items()}
    rows = rows.filter(present)
    out: dict[str, float | None] = dict.fromkeys(sizes)
    if any(0 < n <= order_rows for n in sizes.values()):
        few = rows
        if any(n > order_rows for n in sizes.values()):
            few = rows.filter(F.col("f").isin([f for f, n in sizes.items() if n <= order_rows]))
        out.update({r["f"]: r["m"] for r in few.groupBy("f").agg(F.percentile("v", F.lit(q)).alias("m")).collect()})
    wanted = {f: _rank_pair(n, q) for f, n in sizes.items() if n > order_rows}
    found: dict[tuple[str, int], float] = {}
    spans = {}
    for f, cells in _grid_cells(rows, {f: ends[f][1:] for f in wanted}).items():
        for rank in set(wanted[f]):
            value, span = _cell_of(cells, rank)
            if span is None:
                found[f, rank] = value
            else:
                spans[f, rank] = span
    while spans:
        wide = {k: s for k, s in spans.items() if s[3] > order_rows}
        if not wide:
            found.update(_order_inside(rows, _span_table(spark, spans)))
            break
        probes = _probe(rows, _span_table(spark, wide))
        for r in _count_around(rows, spark.createDataFrame(probes, _PROBE_SCHEMA)):
            key, rank = (r["f"], r["r"]), r["r"]
            lo, hi, below, inside = spans[key]
            edges = [r["lt_x"], r["lt_x"] + r["eq_x"], r["lt_y"], r["lt_y"] + r["eq_y"]]
            if rank < edges[0]:
                spans[key] = (lo, r["x"], below, edges[0] - below)
            elif rank < edges[1]:
                found[key] = r["x"]
                del spans[key]
            elif rank < edges[2]:
                spans[key] = (r["x"], r["y"], edges[1], edges[2] - edges[1])
            elif rank < edges[3]:
                found[key] = r["y"]
                del spans[key]
            else:
                spans[key] = (r["y"], hi, edges[3], below + inside - edges[3])
    for f, (first, last) in wanted.items():
        part = (sizes[f] - 1) * q - first
        out[f] = found[(f, first)] * (1 - part) + found[(f, last)] * part
    return out


_GRID = 1000
_SPAN_SCHEMA = "f string, r long, lo double, hi double, below long, inside long"
_PROBE_SCHEMA = "f string, r long, x double, y double"


def _rank_pair(n: int, q: float) -> tuple[int, int]:
    pos = (n - 1) * q
    return math.floor(pos), math.ceil(pos)


def _grid_cells(rows: DataFrame, ends: dict) -> dict[str, list]:
    """(rows, least, greatest) of the cells of an even grid over the values of each feature, in order; rounding
    keeps the order of values, so cells never overlap. Ends too far apart for doubles make one cell."""
    if not ends:
        return {}
    table = rows.sparkSession.createDataFrame([(f, lo, hi) for f, (lo, hi) in ends.items()], "f string, lo double, hi double")
    part = F.try_divide(F.col("v") - F.col("lo"), F.col("hi") - F.col("lo"))
    cell = F.when(part.between(0.0, 1.0), F.floor(part * _GRID)).otherwise(0)
    whole = F.col("hi") - F.col("lo") < float("inf")
    cells = rows.join(F.broadcast(table), "f").groupBy("f", F.when(whole, cell).otherwise(0).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    out: dict[str, list] = {}
    for r in sorted(cells, key=lambda r: (r["f"], r["cell"])):
        out.setdefault(r["f"], []).append((r["n"], r["lo"], r["hi"]))
    return out


def _cell_of(cells: list, rank: int) -> tuple[float | None, tuple | None]:
    """(the value, None) where the cell with a rank holds one value, else (None, its open interval)."""
    below = 0
    for i, (n, lo, hi) in enumerate(cells):
        if rank < below + n:
            if lo == hi:
                return lo, None
            before = cells[i - 1][2] if i else None
            after = cells[i + 1][1] if i + 1 < len(cells) else None
            return None, (before, after, below, n)
        below += n
    raise ValueError("the rank exceeds the values")


def _span_table(spark, spans: dict) -> DataFrame:
    return spark.createDataFrame([(*key, *span) for key, span in spans.items()], _SPAN_SCHEMA)


def _held(rows: DataFrame, spans: DataFrame) -> DataFrame:
    above = F.col("lo").isNull() | (F.col("v") > F.col("lo"))
    under = F.col("hi").isNull() | (F.col("v") < F.col("hi"))
    return rows.join(F.broadcast(spans), "f").filter(above & under)


def _probe(rows: DataFrame, spans: DataFrame) -> list:
    """Two actual values around each wanted rank."""
    grid = F.percentile_approx("v", [i / _GRID for i in range(_GRID + 1)], 10 * _GRID)
    share = (F.col("r") - F.col("below")) / F.col("inside") * _GRID
    return (
        _held(rows, spans).groupBy("f", "r", "below", "inside").agg(grid.alias("grid")).select(
            "f", "r",
            F.element_at("grid", F.greatest(F.floor(share), F.lit(1)).cast("int")).alias("x"),
            F.element_at("grid", F.least(F.ceil(share) + 2, F.lit(_GRID + 1)).cast("int")).alias("y"),
        ).collect()
    )


def _count_around(rows: DataFrame, probes: DataFrame) -> list:
    v, x, y = F.col("v"), F.col("x"), F.col("y")
    return rows.join(F.broadcast(probes), "f").groupBy("f", "r", "x", "y").agg(
        F.count(F.when(v < x, 1)).alias("lt_x"), F.count(F.when(v == x, 1)).alias("eq_x"),
        F.count(F.when(v < y, 1)).alias("lt_y"), F.count(F.when(v == y, 1)).alias("eq_y"),
    ).collect()


def _order_inside(rows: DataFrame, spans: DataFrame) -> dict:
    """Order the few values left inside each interval and read off the rank."""
    counts = _held(rows, spans).groupBy("f", "r", "below", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(W.partitionBy("f", "r").orderBy("v")) + F.col("below")
    hit = counts.withColumn("upto", upto).filter(F.col("upto") > F.col("r"))
    return {(r["f"], r["r"]): r["v"] for r in hit.groupBy("f", "r").agg(F.min("v").alias("v")).collect()}


# --- even bins over a value ----------------------------------------------------------

FEW_CUTS = 100


def cut_values(cuts: DataFrame | None) -> dict[str, np.ndarray]:
    """All cut values of each group of a table made by ``value_cuts``, in order; none for one bin."""
    found = [] if cuts is None else cuts.collect()
    return {r[0]: np.sort(np.concatenate([r["coarse"], *r["fine"]])) for r in found}


def with_value_bins(df: DataFrame, cuts: DataFrame | None, by: str, value: str, name: str = "bin") -> DataFrame:
    """Number of the even bin a value falls in, by the cut table of ``value_cuts``.

    Few cuts come in two levels, so a value is compared with about 2 * sqrt(bins) of them; many are searched
    by halving, a batch of values at once.
    """
    if cuts is None:
        return df.withColumn(name, F.lit(0))
    levels = cut_values(cuts)
    if max(map(len, levels.values()), default=0) > FEW_CUTS:
        @F.pandas_udf("int")
        def place(group: pd.Series, at: pd.Series) -> pd.Series:
            codes, names = pd.factorize(group)
            values, out = at.to_numpy(dtype=float), np.zeros(len(at), np.int32)
            for code, each in enumerate(names):
                mine = codes == code
                out[mine] = np.searchsorted(levels[each], values[mine], side="right")
            return pd.Series(out)

        return df.join(F.broadcast(cuts.select(by)), by).withColumn(name, place(F.col(by), F.col(value).cast("double")))
    passed = lambda cut_list: F.size(F.filter(cut_list, lambda c: c <= F.col(value)))
    joined = df.join(F.broadcast(cuts), by).withColumn("_c", passed(F.col("coarse")))
    fine = passed(F.element_at("fine", F.col("_c") + 1))
    return joined.withColumn(name, F.col("_c") * F.col("width") + fine).drop("coarse", "fine", "width", "_c")


WORTH_SPLITTING = 1_000_000  # rows that are worth a task of their own
LEAST_RUNS = 64


def bin_count(spark: SparkSession, largest: int, rows_per_bin: int) -> int:
    """Bins for a group of ``largest`` rows: of about ``rows_per_bin`` rows, or one a slot where that is worth a task."""
    slots = spark.sparkContext.defaultParallelism
    return max(math.ceil(largest / rows_per_bin), min(slots, math.ceil(largest / WORTH_SPLITTING)))


def run_rows(largest: int, rows_per_bin: int) -> int:
    """Rows of a run of neighbouring bins that one task settles together, in a group of ``largest`` rows: a bin where
    there are few; of many small ones so many that runs stay enough to share out, and never more than a task can hold."""
    return min(WORTH_SPLITTING, max(rows_per_bin, math.ceil(largest / LEAST_RUNS)))


def value_cuts(df: DataFrame, by: str, value: str, sizes: DataFrame, rows_per_bin: int) -> DataFrame | None:
    """Cut values per group that put about ``rows_per_bin`` rows in a bin; None for one bin.

    ``sizes`` holds the rows ``n`` of each group.

    Cuts are read once into literals, so every later stage bins alike even when a
    task is run again. They only balance the work: results do not depend on them.
    """
    largest = sizes.agg(F.max("n")).first()[0] or 0
    bins = bin_count(df.sparkSession, largest, rows_per_bin)
    if bins <= 1:
        return None
    width = math.ceil(math.sqrt(bins))
    shares = [i / (width * width) for i in range(1, width * width)]
    rows = df.groupBy(by).agg(F.percentile_approx(value, shares, 10 * width * width).alias("cuts")).collect()
    table = []
    for r in rows:
        cuts = r["cuts"]
        blocks = [cuts[i * width : i * width + width - 1] for i in range(width)]
        table.append((r[by], cuts[width - 1 :: width], blocks, width))
    return df.sparkSession.createDataFrame(
        table, f"`{by}` string, coarse array<double>, fine array<array<double>>, width int"
    )
