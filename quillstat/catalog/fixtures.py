"""Inputs of the named queries: Spark tables and the same tables as SQL CTEs.

The given tables hold no missing values, so some are made here, by the same rule
on both sides, for the preparation steps to act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstat.operators.prep import apply_imputation, apply_scaling, fit_medians, fit_scaling
from quillstat.operators.sampling import with_split
from quillstat.session import keep
from quillstat.sources.tables import read_table

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
FLAG = "l_returnflag"
FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SIX = [*FEATURES, "l_net", "l_unit"]
CLASSES = ["A", "N", "R"]
DISPLAY = {"A": "Accepted", "N": "None", "R": "Returned", "X": "Never"}
N_DIMS = 64
DIMS = [f"e{i:02d}" for i in range(N_DIMS)]


def tall(spark: SparkSession, sf: str, spread: bool = False) -> DataFrame:
    """lineitem features with made gaps in discount and tax."""
    df = read_table(spark, sf, "lineitem", [*KEYS, FLAG, *FEATURES], spread)
    return df.withColumns({
        "l_discount": F.when(F.col("l_linenumber") != 3, F.col("l_discount")),
        "l_tax": F.when(F.col("l_linenumber") != 7, F.col("l_tax")),
    })


TALL = """
t AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice,
         CASE WHEN l_linenumber <> 3 THEN l_discount END AS l_discount,
         CASE WHEN l_linenumber <> 7 THEN l_tax END AS l_tax
  FROM lineitem)"""


def split_sql(source: str, target: str, y: str, keys: list[str], seed: int = 42, share: float = 0.2) -> str:
    """CTEs that add the exact stratified ``split`` to ``source``."""
    text = ", ".join(keys)
    return f"""
{target}_sizes AS (SELECT {y} AS c, count(*) AS nc FROM {source} GROUP BY 1),
{target}_exact AS (
  SELECT c, nc, ceil(CAST({share} AS DOUBLE) * sum(nc) OVER ()) AS want,
         ceil(CAST({share} AS DOUBLE) * sum(nc) OVER ()) * nc / CAST(sum(nc) OVER () AS DOUBLE) AS part
  FROM {target}_sizes),
{target}_quota AS (
  SELECT c, floor(part) + CASE WHEN
           row_number() OVER (ORDER BY round(part - floor(part), 12) DESC, c)
           <= want - sum(floor(part)) OVER () THEN 1 ELSE 0 END AS q
  FROM {target}_exact),
{target} AS (
  SELECT s.* EXCLUDE (rn), CASE WHEN s.rn <= q.q THEN 'test' ELSE 'train' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {y} ORDER BY md5(concat_ws('|', '{seed}', {text}))) AS rn
        FROM {source}) s JOIN {target}_quota q ON s.{y} = q.c)"""


def tall_split(spark: SparkSession, sf: str) -> DataFrame:
    return keep(with_split(tall(spark, sf, spread=True), FLAG, KEYS))


TALL_SPLIT = TALL + "," + split_sql("t", "ts", FLAG, KEYS)


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    """Split, median-imputed and standardised lineitem features."""
    df = tall_split(spark, sf)
    train = df.filter("split = 'train'")
    filled = apply_imputation(df, fit_medians(train, FEATURES))
    return apply_scaling(filled, fit_scaling(filled.filter("split = 'train'"), FEATURES))


def _imputed(f: str) -> str:
    return f"coalesce({f}, (SELECT median({f}) FROM ts WHERE split = 'train')) AS {f}"


def _scaled(f: str) -> str:
    return (
        f"({f} - (SELECT avg({f}) FROM ti WHERE split = 'train')) / "
        f"(SELECT CASE WHEN stddev_pop({f}) = 0 THEN 1 ELSE stddev_pop({f}) END FROM ti WHERE split = 'train') AS {f}"
    )


IMPUTED = TALL_SPLIT + f""",
ti AS (SELECT {", ".join(KEYS)}, {FLAG}, split, {", ".join(map(_imputed, FEATURES))} FROM ts)"""
PREPARED = IMPUTED + f""",
tp AS (SELECT {", ".join(KEYS)}, {FLAG}, split, {", ".join(map(_scaled, FEATURES))} FROM ti)"""


def six(spark: SparkSession, sf: str, spread: bool = False) -> DataFrame:
    """Six lineitem features with two derived ones, for collinearity work."""
    df = read_table(spark, sf, "lineitem", [*KEYS, FLAG, *FEATURES], spread)
    return df.withColumns({
        "l_net": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "l_unit": F.col("l_extendedprice") / F.col("l_quantity"),
    })


SIX_SQL = """
s AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax,
         l_extendedprice * (1 - l_discount) AS l_net, l_extendedprice / l_quantity AS l_unit
  FROM lineitem)"""


def long_sql(source: str, target: str, features: list[str], keep: str) -> str:
    parts = [f"SELECT {keep}, '{f}' AS feature, {f} AS value FROM {source}" for f in features]
    return f"{target} AS ({' UNION ALL '.join(parts)})"


def wide(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings with the vector as an array of doubles and a text label."""
    return read_table(spark, sf, "embeddings", spread=True).select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), F.col("label").cast("string").alias("label")
    )


WIDE = """
w AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS VARCHAR) AS label FROM embeddings)"""


def wide_columns(spark: SparkSession, sf: str) -> DataFrame:
    df = wide(spark, sf)
    return df.select("vec_id", "label", *[F.col("x")[i].alias(n) for i, n in enumerate(DIMS)])


WIDE_COLUMNS = f"""
wc AS (SELECT vec_id, CAST(label AS VARCHAR) AS label,
       {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {n}" for i, n in enumerate(DIMS))} FROM embeddings)"""


def wide_long(spark: SparkSession, sf: str) -> DataFrame:
    df = wide(spark, sf)
    spread = df.select("vec_id", "label", F.posexplode("x").alias("i", "value"))
    return spread.select("vec_id", "label", F.format_string("e%02d", "i").alias("feature"), "value")


WIDE_LONG = WIDE + """,
wl AS (SELECT vec_id, label, 'e' || lpad(CAST(i - 1 AS VARCHAR), 2, '0') AS feature, x[i] AS value
       FROM (SELECT *, unnest(range(1, 65)) AS i FROM w))"""


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Two rule-made predictions of the return flag with class probabilities."""
    df = read_table(spark, sf, "lineitem", [*KEYS, FLAG, *FEATURES])
    raw = [1 + 10 * F.col("l_discount"), 1 + 10 * F.col("l_tax"), F.col("l_quantity") / 25.0]
    total = raw[0] + raw[1] + raw[2]
    probs = {f"prob_{c}": r / total for c, r in zip(CLASSES, raw)}
    return df.select(
        *KEYS, F.col(FLAG).alias("y"),
        F.when(F.col("l_quantity") < 17, "A").when(F.col("l_quantity") < 34, "N").otherwise("R").alias("rule_size"),
        F.when(F.col("l_extendedprice") < 30000, "A").otherwise("R").alias("rule_price"),
        F.when(F.col("l_linenumber") <= 5, "train").otherwise("test").alias("split"),
        *[e.alias(n) for n, e in probs.items()],
    )


PREDICTIONS = """
p0 AS (
  SELECT *, 1 + 10 * l_discount AS wa, 1 + 10 * l_tax AS wn, l_quantity / 25.0 AS wr FROM lineitem),
p AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag AS y,
         CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN 'N' ELSE 'R' END AS rule_size,
         CASE WHEN l_extendedprice < 30000 THEN 'A' ELSE 'R' END AS rule_price,
         CASE WHEN l_linenumber <= 5 THEN 'train' ELSE 'test' END AS split,
         wa / (wa + wn + wr) AS "prob_A", wn / (wa + wn + wr) AS "prob_N", wr / (wa + wn + wr) AS "prob_R"
  FROM p0),
pm AS (
  SELECT 'rule_size' AS model, split, y, rule_size AS pred FROM p
  UNION ALL SELECT 'rule_price', split, y, rule_price FROM p)"""


def model_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """(model, split, y, pred) rows of both rules."""
    return predictions(spark, sf).unpivot(["split", "y"], ["rule_size", "rule_price"], "model", "pred")


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round the named float columns, after all computation, for comparison."""
    return df.withColumns({n: F.round(n, digits) for n in names})
