"""Split, fold, weight, imputation, scaling and expansion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstat.catalog.fixtures import (
    CLASSES, DIMS, FEATURES, FLAG, IMPUTED, KEYS, PREPARED, TALL, TALL_SPLIT, WIDE, prepared, rounded, tall,
    tall_split, wide, long_sql,
)
from quillstat.catalog.registry import REGISTRY, query
from quillstat.operators import moments, prep, sampling, screening
from quillstat.sources.tables import read_table


@query(f"WITH {TALL_SPLIT} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, split FROM ts")
def stratified_split(spark, sf):
    return tall_split(spark, sf).select(*KEYS, "split")


@query(f"""
WITH {TALL}, r AS (
  SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY
            md5(concat_ws('|', '42', l_orderkey, l_partkey, l_suppkey, l_linenumber))) AS rn,
         count(*) OVER (PARTITION BY l_returnflag) AS nc FROM t)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CAST(rn > 1 * nc // 5 AS INTEGER) + CAST(rn > 2 * nc // 5 AS INTEGER)
       + CAST(rn > 3 * nc // 5 AS INTEGER) + CAST(rn > 4 * nc // 5 AS INTEGER) AS fold
FROM r""")
def stratified_folds(spark, sf):
    return sampling.with_folds(tall(spark, sf, spread=True), FLAG, KEYS, 5).select(*KEYS, "fold")


@query("""
SELECT doc_id, quality, round(count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY quality)), 8) AS weight
FROM labels""")
def class_weights(spark, sf):
    df = read_table(spark, sf, "labels", ["doc_id", "quality"])
    weighted = sampling.with_class_weight(df, "quality", sampling.class_weights(df, "quality"))
    return rounded(weighted, 8, "weight")


@query(f"""
WITH {TALL_SPLIT}, {long_sql("ts", "l", FEATURES, "split")}
SELECT feature, 'median' AS imputation_strategy,
       round(median(value) FILTER (split = 'train'), 8) AS imputation_value_fitted_on_train,
       count(*) FILTER (split = 'train' AND value IS NULL) AS train_missing_count_before,
       count(*) FILTER (split = 'test' AND value IS NULL) AS test_missing_count_before
FROM l GROUP BY 1""")
def imputation_values(spark, sf):
    df = tall_split(spark, sf)
    medians = prep.fit_medians(df.filter("split = 'train'"), FEATURES)
    return rounded(prep.imputation_report(df, "split", medians), 8, "imputation_value_fitted_on_train")


@query(f"""
WITH {IMPUTED}, {long_sql("ti", "l", FEATURES, "split")}
SELECT feature, round(avg(value), 6) AS train_mean_used_for_scaling,
       round(stddev_pop(value), 6) AS train_std_used_for_scaling FROM l WHERE split = 'train' GROUP BY 1""")
def scaling_parameters(spark, sf):
    train = tall_split(spark, sf).filter("split = 'train'")
    filled = prep.apply_imputation(train, prep.fit_medians(train, FEATURES))
    report = prep.scaling_report(spark, prep.fit_scaling(filled, FEATURES))
    return rounded(report, 6, "train_mean_used_for_scaling", "train_std_used_for_scaling")


@query(f"""
WITH {PREPARED}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, split,
       {", ".join(f"round({f}, 8) AS {f}" for f in FEATURES)} FROM tp""")
def prepared_rows(spark, sf):
    return rounded(prepared(spark, sf), 8, *FEATURES)


@query(f"""
WITH {PREPARED}, {long_sql("tp", "l", FEATURES, "split, l_returnflag AS y")},
g AS (SELECT feature, y, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM l WHERE split = 'train' GROUP BY 1, 2),
h AS (SELECT feature, sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS m FROM g GROUP BY 1),
f AS (SELECT g.feature, any_value(h.n) AS n, any_value(h.k) AS k,
             (sum(g.n * (g.m - h.m) ** 2) / (any_value(h.k) - 1)) / (sum(g.n * v) / (any_value(h.n) - any_value(h.k))) AS f
      FROM g JOIN h ON g.feature = h.feature GROUP BY 1)
SELECT feature, round(f, 6) AS anova_f_score, round((1 + 2 * f / (n - k)) ** (-(n - k) / 2.0), 8) AS anova_p_value,
       rank() OVER (ORDER BY f DESC) AS anova_rank FROM f""")
def anova_feature_ranking(spark, sf):
    train = prepared(spark, sf).filter("split = 'train'")
    scores = screening.anova_of(moments.feature_moments(train, [FLAG], FEATURES), FLAG)
    return rounded(scores.select("feature", "anova_f_score", "anova_p_value", "anova_rank"), 6, "anova_f_score").withColumn(
        "anova_p_value", F.round("anova_p_value", 8))


_EXPANDED_FOUR = [*FEATURES, *[f"{f}_sq" for f in FEATURES],
                  *[f"{a}_x_{b}" for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]]]


@query(f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {", ".join(FEATURES)},
       {", ".join(f"{f} * {f} AS {f}_sq" for f in FEATURES)},
       {", ".join(f"{a} * {b} AS {a}_x_{b}" for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:])}
FROM lineitem""")
def expanded_columns(spark, sf):
    df = read_table(spark, sf, "lineitem", [*KEYS, *FEATURES])
    return prep.expand_columns(df, FEATURES, KEYS)


@query(f"""
WITH {WIDE}, terms AS (
  SELECT vec_id, list_concat(list_concat(x, [v * v FOR v IN x]),
         flatten([[x[i] * x[j] FOR j IN range(i + 1, 65)] FOR i IN range(1, 65)])) AS z FROM w)
SELECT vec_id, len(z) AS n_terms, round(list_sum(z), 8) AS term_sum, round(z[65], 8) AS first_square,
       round(z[129], 8) AS first_product, round(z[2144], 8) AS last_product FROM terms""")
def expanded_vectors(spark, sf):
    z = wide(spark, sf).select("vec_id", prep.expand_array(F.col("x")).alias("z"))
    names = prep.expanded_names(DIMS)
    at = lambda n: F.element_at("z", names.index(n) + 1)
    out = z.select(
        "vec_id", F.size("z").cast("long").alias("n_terms"),
        F.aggregate("z", F.lit(0.0), lambda a, v: a + v).alias("term_sum"),
        at("e00_sq").alias("first_square"), at("e00_x_e01").alias("first_product"), at("e62_x_e63").alias("last_product"))
    return rounded(out, 8, "term_sum", "first_square", "first_product", "last_product")


@query("""
WITH s AS (
  SELECT 'c_acctbal' AS feature, avg((c_acctbal - m) ** 3) / avg((c_acctbal - m) ** 2) ** 1.5 AS skewness, min(c_acctbal) AS smallest
  FROM customer, (SELECT avg(c_acctbal) AS m FROM customer)
  UNION ALL
  SELECT 'value', avg((value - m) ** 3) / avg((value - m) ** 2) ** 1.5, min(value)
  FROM events, (SELECT avg(value) AS m FROM events))
SELECT feature, round(skewness, 6) AS skewness, smallest FROM s""")
def skewness_table(spark, sf):
    a = prep.skewness_table(read_table(spark, sf, "customer", ["c_acctbal"]), ["c_acctbal"])
    b = prep.skewness_table(read_table(spark, sf, "events", ["value"]), ["value"])
    return rounded(a.unionByName(b), 6, "skewness")


@query("""
SELECT event_id, round(CASE WHEN (SELECT avg((value - m) ** 3) / avg((value - m) ** 2) ** 1.5 > 1.0 AND min(value) >= 0
                     FROM events, (SELECT avg(value) AS m FROM events))
       THEN ln(1 + value) ELSE value END, 6) AS value FROM events""")
def log_transformed(spark, sf):
    df = read_table(spark, sf, "events", ["event_id", "value"])
    return rounded(prep.log_transform(df, prep.skewed_features(df, ["value"])), 6, "value")


@query(f"""
WITH {TALL} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount
FROM t WHERE (CASE WHEN l_discount IS NULL THEN 1 ELSE 0 END) <= 0.25 * 3""")
def dense_part(spark, sf):
    """Tax is missing in more than half of the rows and goes; then rows with a gap go."""
    df = tall(spark, sf).withColumn("l_tax", F.when(F.col("l_linenumber") <= 3, F.col("l_tax")))
    sparse = set(prep.sparse_columns(df, FEATURES, 0.5))
    kept = [f for f in FEATURES if f not in sparse]
    return prep.drop_sparse_rows(df.select(*KEYS, *kept), kept, 0.25)


# --- the same results with parameters that reach the branches for large tables ---------------

@query(REGISTRY["stratified_split"].sql)
def stratified_split_small_buckets(spark, sf):
    return sampling.with_split(tall(spark, sf), FLAG, KEYS, order_rows=20).select(*KEYS, "split")


@query(REGISTRY["stratified_folds"].sql)
def stratified_folds_small_buckets(spark, sf):
    return sampling.with_folds(tall(spark, sf), FLAG, KEYS, 5, order_rows=20).select(*KEYS, "fold")


@query(REGISTRY["imputation_values"].sql)
def imputation_values_narrowed(spark, sf):
    df = tall_split(spark, sf)
    medians = prep.fit_medians(df.filter("split = 'train'"), FEATURES, order_rows=1000)
    return rounded(prep.imputation_report(df, "split", medians), 8, "imputation_value_fitted_on_train")
