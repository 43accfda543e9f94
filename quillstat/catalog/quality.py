"""Cleaning, quality, duplicate and class-summary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstat.catalog.fixtures import (
    CLASSES, DIMS, DISPLAY, FEATURES, FLAG, IMPUTED, KEYS, PREPARED, TALL, TALL_SPLIT, WIDE_LONG, prepared, rounded, tall,
    tall_split, wide_columns, long_sql,
)
from quillstat.catalog.registry import query
from quillstat.functions.scalars import clean_text, finite_or, joined_label, label_map, with_size_guides
from quillstat.operators import duplicates, quality, summaries
from quillstat.operators.prep import apply_imputation, coerce_numeric, fit_medians
from quillstat.sources.tables import read_table


def _null_counts(features, source, keys=""):
    lead = f"{keys}, " if keys else ""
    parts = [
        f"SELECT {lead}'{f}' AS feature, count(*) AS n, count(*) - count({f}) AS k FROM {source}"
        + (f" GROUP BY {keys}" if keys else "")
        for f in features
    ]
    return " UNION ALL ".join(parts)


@query("""
SELECT l_returnflag, count(*) AS count, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent
FROM lineitem GROUP BY 1""")
def class_distribution(spark, sf):
    df = read_table(spark, sf, "lineitem", [FLAG])
    return rounded(summaries.class_distribution(df, FLAG), 6, "percent")


@query(f"""
WITH {TALL_SPLIT},
d(class_raw, class_display) AS (VALUES {", ".join(f"('{a}', '{b}')" for a, b in DISPLAY.items())}),
g AS (SELECT split, class_raw, class_display FROM d CROSS JOIN (VALUES ('train'), ('test'), ('total')) v(split)),
c AS (SELECT split, l_returnflag AS c, count(*) AS n FROM ts GROUP BY 1, 2
      UNION ALL SELECT 'total', l_returnflag, count(*) FROM ts GROUP BY 2)
SELECT g.split, g.class_raw, g.class_display, coalesce(c.n, 0) AS count,
       round(coalesce(c.n, 0) / CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY g.split) AS DOUBLE), 8) AS proportion
FROM g LEFT JOIN c ON g.split = c.split AND g.class_raw = c.c""")
def class_distribution_by_split(spark, sf):
    df = tall_split(spark, sf)
    return rounded(summaries.class_distribution_full(df, FLAG, "split", DISPLAY), 8, "proportion")


@query(f"""
WITH {TALL}, m AS ({_null_counts(FEATURES, "t")})
SELECT feature, k AS missing_count, round(100.0 * k / n, 6) AS missing_percent FROM m""")
def missing_by_feature(spark, sf):
    return rounded(quality.missing_by_feature(tall(spark, sf), FEATURES), 6, "missing_percent")


@query(f"""
WITH {IMPUTED}, m AS (
  SELECT split, 'before_imputation' AS stage, feature, n, k FROM ({_null_counts(FEATURES, "ts", "split")})
  UNION ALL SELECT split, 'after_imputation', feature, n, k FROM ({_null_counts(FEATURES, "ti", "split")})
  UNION ALL SELECT 'full_dataset', 'before_imputation', feature, n, k FROM ({_null_counts(FEATURES, "ts")}))
SELECT split, stage, feature, k AS missing_count, round(100.0 * k / n, 6) AS missing_percent FROM m""")
def missing_by_stage(spark, sf):
    df = tall_split(spark, sf)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    medians = fit_medians(train, FEATURES)
    report = quality.missing_by_stage({
        ("full_dataset", "before_imputation"): df,
        ("train", "before_imputation"): train, ("test", "before_imputation"): test,
        ("train", "after_imputation"): apply_imputation(train, medians),
        ("test", "after_imputation"): apply_imputation(test, medians),
    }, FEATURES)
    return rounded(report, 6, "missing_percent")


@query(f"""
WITH {TALL_SPLIT}, m AS ({_null_counts(FEATURES, "ts", "split")})
SELECT split, feature AS "column", k AS n_missing, round(k / CAST(n AS DOUBLE), 8) AS missing_rate FROM m WHERE k > 0""")
def missing_columns_by_split(spark, sf):
    return rounded(quality.missing_columns(tall_split(spark, sf), FEATURES, "split"), 8, "missing_rate")


@query(f"""
WITH {TALL}
SELECT count(*) FILTER (l_discount IS NULL OR l_tax IS NULL) AS rows_with_missing,
       count(*) FILTER (l_discount IS NOT NULL AND l_tax IS NOT NULL) AS complete_rows,
       2 * count(*) - count(l_discount) - count(l_tax) AS missing_cells
FROM t""")
def row_completeness(spark, sf):
    return quality.row_completeness(tall(spark, sf), FEATURES)


@query("""
WITH c AS (SELECT c_mktsegment AS c, count(*) AS n FROM customer GROUP BY 1)
SELECT (SELECT c FROM c ORDER BY n DESC, c LIMIT 1) AS majority_class, max(n) AS majority_count,
       round(max(n) / CAST(sum(n) AS DOUBLE), 8) AS majority_accuracy FROM c""")
def majority_class(spark, sf):
    df = read_table(spark, sf, "customer", ["c_mktsegment"])
    return rounded(summaries.majority_class(df, "c_mktsegment"), 8, "majority_accuracy")


@query(f"""
WITH {WIDE_LONG},
c AS (SELECT feature, label, avg(value) AS m FROM wl GROUP BY 1, 2),
g AS (SELECT feature, avg(value) AS m FROM wl GROUP BY 1)
SELECT c.feature, round(max(abs(c.m - g.m)), 8) AS class_mean_contrast FROM c JOIN g ON c.feature = g.feature GROUP BY 1""")
def class_mean_contrast(spark, sf):
    return rounded(summaries.class_mean_contrast(wide_columns(spark, sf), "label", DIMS), 8, "class_mean_contrast")


@query("""
SELECT source, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'en') AS en,
       count(*) FILTER (lang = 'es') AS es, count(*) FILTER (lang = 'fr') AS fr, count(*) FILTER (lang = 'xx') AS xx
FROM documents GROUP BY 1""")
def cross_table(spark, sf):
    df = read_table(spark, sf, "documents", ["source", "lang"])
    return summaries.cross_table(df, "source", "lang", ["de", "en", "es", "fr", "xx"])


@query("""
WITH r AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT CAST(least(floor((l_extendedprice - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS n
FROM lineitem, r GROUP BY 1""")
def histogram_counts(spark, sf):
    df = read_table(spark, sf, "lineitem", ["l_extendedprice"])
    return summaries.histogram(df, F.col("l_extendedprice"), 30)


def _entries(spark, sf):
    df = tall_split(spark, sf)
    return df.select(
        F.concat_ws("-", *KEYS).alias("entry_id"), F.col("l_partkey").cast("string").alias("word"),
        F.col(FLAG).alias("target"), *FEATURES, "split",
    )


_ENTRIES = TALL_SPLIT + """,
e AS (SELECT concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS entry_id,
             CAST(l_partkey AS VARCHAR) AS word, l_returnflag AS target,
             l_quantity, l_extendedprice, l_discount, l_tax, split FROM ts),
es AS (SELECT * FROM e UNION ALL SELECT * REPLACE ('total' AS split) FROM e)"""
_ENTRY_IDS = ["entry_id", "word", "target"]


@query(f"""
WITH {_ENTRIES},
u AS (SELECT split, count(*) AS k FROM (SELECT DISTINCT * FROM es) GROUP BY 1)
SELECT es.split, count(*) AS n_observations, 7 AS n_total_columns, 3 AS n_identifier_columns, 4 AS n_features,
       2 * count(*) - count(l_discount) - count(l_tax) AS n_missing_cells,
       count(*) - any_value(u.k) AS n_exact_duplicate_rows,
       count(*) - count(DISTINCT entry_id) AS n_duplicated_ids, count(*) - count(DISTINCT word) AS n_duplicated_words
FROM es JOIN u ON es.split = u.split GROUP BY es.split""")
def dataset_shape_summary(spark, sf):
    return quality.shape_summary(_entries(spark, sf), "split", _ENTRY_IDS, FEATURES, "entry_id", "word")


@query(f"""
WITH {_ENTRIES}
SELECT CASE WHEN split = 'total' THEN 'combined' ELSE split END AS split, count(*) AS n_observations, 4 AS n_features,
       2 * count(*) - count(l_discount) - count(l_tax) AS n_missing_values,
       {", ".join(f'''count(*) FILTER (target = '{c}') AS "n_{c}",
       round(count(*) FILTER (target = '{c}') / CAST(count(*) AS DOUBLE), 8) AS "pct_{c}"''' for c in CLASSES)}
FROM es GROUP BY 1""")
def class_shape_wide(spark, sf):
    out = quality.class_shape_wide(_entries(spark, sf), "split", "target", FEATURES, CLASSES)
    return rounded(out, 8, *[f"pct_{c}" for c in CLASSES])


@query(f"""
WITH {TALL_SPLIT}
SELECT 'n_' || split AS metric, count(*) AS value FROM ts GROUP BY split
UNION ALL SELECT 'n_' || split || '_' || l_returnflag, count(*) FROM ts GROUP BY split, l_returnflag
UNION ALL SELECT 'n_features', 4 UNION ALL SELECT 'n_selected_features', 3""")
def dataset_facts(spark, sf):
    return quality.dataset_facts(tall_split(spark, sf), "split", FLAG, 4, 3)


@query(f"""
WITH {TALL_SPLIT},
g AS (SELECT split, c FROM (VALUES ('train'), ('test')) a(split) CROSS JOIN (VALUES ('A'), ('N'), ('R'), ('X')) b(c)),
c AS (SELECT split, l_returnflag AS c, count(*) AS n FROM ts GROUP BY 1, 2)
SELECT g.split, g.c AS l_returnflag, coalesce(c.n, 0) AS n, c.n IS NOT NULL AS present
FROM g LEFT JOIN c ON g.split = c.split AND g.c = c.c""")
def class_presence(spark, sf):
    return quality.class_presence(tall_split(spark, sf), FLAG, "split", [*CLASSES, "X"], ["train", "test"])


@query("SELECT min(n) AS smallest_class FROM (SELECT count(*) AS n FROM documents GROUP BY lang)")
def smallest_class(spark, sf):
    return quality.smallest_class(read_table(spark, sf, "documents", ["lang"]), "lang")


@query(f"""
WITH {PREPARED}, {long_sql("tp", "l", FEATURES, "split")},
m AS (SELECT split, feature, avg(value) AS m, stddev_pop(value) AS s FROM l GROUP BY 1, 2)
SELECT split, round(max(abs(m)), 8) AS max_abs_feature_mean, round(avg(abs(m)), 8) AS mean_abs_feature_mean,
       round(min(s), 8) AS min_feature_std, round(max(s), 8) AS max_feature_std, round(avg(s), 8) AS mean_feature_std,
       count(*) FILTER (abs(s) <= 1e-12) AS n_zero_variance_features
FROM m GROUP BY 1""")
def standardisation_report(spark, sf):
    out = quality.standardisation_report(prepared(spark, sf), "split", FEATURES)
    return rounded(out, 8, *[c for c in out.columns if c.endswith(("mean", "std"))])


def _bad_labels(spark, sf):
    df = read_table(spark, sf, "lineitem", [*KEYS, FLAG])
    bad = F.when(F.col("l_linenumber") == 2, F.concat(F.lit("  "), FLAG, F.lit("\t"))).when(
        F.col("l_linenumber") == 4, "?").when(F.col("l_linenumber") == 6, F.lit(None)).otherwise(F.col(FLAG))
    return df.select(*KEYS, bad.alias("label"))


_BAD_LABELS = """
b AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
             CASE l_linenumber WHEN 2 THEN '  ' || l_returnflag || chr(9) WHEN 4 THEN '?' WHEN 6 THEN NULL
                  ELSE l_returnflag END AS label FROM lineitem),
bc AS (SELECT * REPLACE (regexp_replace(label, '^\\s+|\\s+$', '', 'g') AS label) FROM b)"""


@query(f"""
WITH {_BAD_LABELS}
SELECT count(*) AS rows_in, count(*) FILTER (label IN ('A', 'N', 'R')) AS rows_valid,
       count(*) - count(*) FILTER (label IN ('A', 'N', 'R')) AS rows_invalid FROM bc""")
def label_validity(spark, sf):
    clean = quality.cleaned_labels(_bad_labels(spark, sf), ["label"])
    return quality.label_validity(clean, "label", CLASSES)


@query(f"WITH {_BAD_LABELS} SELECT * FROM bc WHERE label IN ('A', 'N', 'R')")
def valid_label_rows(spark, sf):
    clean = quality.cleaned_labels(_bad_labels(spark, sf), ["label"])
    return quality.with_valid_labels(clean, "label", CLASSES)


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE l_linenumber WHEN 5 THEN NULL WHEN 6 THEN NULL ELSE l_quantity END AS qty,
       CASE l_linenumber WHEN 3 THEN 0.0 ELSE l_tax END AS tax_filled
FROM lineitem""")
def coerced_numbers(spark, sf):
    df = read_table(spark, sf, "lineitem", [*KEYS, "l_quantity", "l_tax"])
    text = F.when(F.col("l_linenumber") == 5, "n/a").when(F.col("l_linenumber") == 6, "12f").otherwise(
        F.concat(F.lit(" "), F.col("l_quantity").cast("string")))
    infinite = F.when(F.col("l_linenumber") == 3, F.lit(float("inf"))).otherwise(F.col("l_tax"))
    return coerce_numeric(df.withColumn("qty", text), ["qty"]).select(
        *KEYS, "qty", finite_or(infinite, 0.0).alias("tax_filled"))


@query("""
SELECT CASE r_regionkey WHEN 0 THEN 'noun' WHEN 1 THEN 'verb' WHEN 2 THEN 'adjective'
            ELSE CAST(r_regionkey AS VARCHAR) END AS kept,
       CASE r_regionkey WHEN 0 THEN 'noun' WHEN 1 THEN 'verb' WHEN 2 THEN 'adjective' END AS strict,
       n_name || ' | ' || r_name AS pair, count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""")
def mapped_labels(spark, sf):
    counts = read_table(spark, sf, "customer", ["c_nationkey"]).groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("customers"))
    nation = read_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = read_table(spark, sf, "region", ["r_regionkey", "r_name"])
    codes = {0: "noun", 1: "verb", 2: "adjective"}
    joined = counts.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        label_map(F.col("r_regionkey"), codes).alias("kept"),
        label_map(F.col("r_regionkey"), codes, keep_unmapped=False).alias("strict"),
        joined_label([F.col("n_name"), F.col("r_name")]).alias("pair"), "customers")


@query("""
WITH n AS (SELECT count(*) AS n, CAST(2144 AS BIGINT) AS p FROM embeddings)
SELECT n, p, round(n / ln(n), 8) AS n_over_log_n, n - 1 AS n_minus_1, least(n, p) AS max_possible_rank,
       p - least(n, p) AS rank_deficiency, p > n AS p_greater_than_n,
       CASE WHEN p > n THEN 'skipped_p_greater_than_n' ELSE 'computed' END AS vif_status FROM n""")
def size_guides(spark, sf):
    from quillstat.operators.collinearity import vif_status

    n = read_table(spark, sf, "embeddings", ["vec_id"]).agg(F.count(F.lit(1)).alias("n"))
    out = with_size_guides(n.withColumn("p", F.lit(2144).cast("long")), "n", "p")
    return rounded(out.withColumn("vif_status", vif_status(F.col("n"), F.col("p"))), 8, "n_over_log_n")


# --- duplicates ----------------------------------------------------------------------

def _with_copies(spark, sf):
    df = read_table(spark, sf, "lineitem", [*KEYS, FLAG, *FEATURES])
    return df.unionByName(df.filter("l_orderkey % 100 = 0"))


_COPIES = """
c0 AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_quantity, l_extendedprice,
              l_discount, l_tax FROM lineitem),
c AS (SELECT * FROM c0 UNION ALL SELECT * FROM c0 WHERE l_orderkey % 100 = 0)"""


@query(f"""
WITH {_COPIES}, d AS (SELECT DISTINCT * FROM c)
SELECT (SELECT count(*) FROM c) AS rows_in, (SELECT count(*) FROM d) AS rows_kept,
       (SELECT count(*) FROM c) - (SELECT count(*) FROM d) AS duplicates_removed""")
def duplicate_count(spark, sf):
    return duplicates.duplicate_count(_with_copies(spark, sf))


@query(f"WITH {_COPIES} SELECT DISTINCT * FROM c")
def without_duplicates(spark, sf):
    return duplicates.without_duplicates(_with_copies(spark, sf))


@query("""
SELECT doc_id, lang, source FROM (SELECT *, count(*) OVER (PARTITION BY text) AS k FROM documents) WHERE k > 1""")
def repeated_texts(spark, sf):
    df = read_table(spark, sf, "documents", ["doc_id", "text", "lang", "source"])
    return duplicates.repeated_keys(df, ["text"], ["doc_id", "lang", "source"])


@query(f"""
WITH {_COPIES}, k AS (SELECT *, CASE WHEN l_linenumber <= 5 THEN 'train' ELSE 'test' END AS split FROM c),
n AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_quantity,
      l_extendedprice, l_discount, l_tax) AS n FROM k)
SELECT * EXCLUDE (n) FROM n WHERE n > 1""")
def duplicates_across_splits(spark, sf):
    df = _with_copies(spark, sf)
    train, test = df.filter("l_linenumber <= 5"), df.filter("l_linenumber > 5")
    return duplicates.repeated_across_splits(train, test, df.columns, [*df.columns, "split"])


@query("""
WITH k AS (SELECT l_quantity, l_discount, l_tax, l_returnflag,
                  CASE WHEN l_linenumber <= 5 THEN 'train' ELSE 'test' END AS split,
                  count(*) OVER (PARTITION BY l_quantity, l_discount, l_tax, l_returnflag) AS n FROM lineitem)
SELECT split, l_returnflag, count(*) AS rows_in_repeats FROM k WHERE n > 1 GROUP BY 1, 2""")
def repeated_feature_rows(spark, sf):
    df = read_table(spark, sf, "lineitem", ["l_quantity", "l_discount", "l_tax", FLAG, "l_linenumber"])
    key = ["l_quantity", "l_discount", "l_tax", FLAG]
    train, test = df.filter("l_linenumber <= 5"), df.filter("l_linenumber > 5")
    hits = duplicates.repeated_across_splits(train, test, key, ["split", FLAG])
    return hits.groupBy("split", FLAG).agg(F.count(F.lit(1)).alias("rows_in_repeats"))


@query(f"""
WITH {TALL_SPLIT}, n AS (SELECT *, count(*) OVER (PARTITION BY l_partkey) AS n FROM ts)
SELECT l_partkey, l_returnflag, split, CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'N' THEN 'None'
       ELSE 'Returned' END AS target_display, l_orderkey, l_linenumber FROM n WHERE n > 1""")
def repeated_words_by_split(spark, sf):
    df = tall_split(spark, sf)
    train, test = df.filter("split = 'train'"), df.filter("split = 'test'")
    return duplicates.repeated_across_splits(train.drop("split"), test.drop("split"), ["l_partkey"], [
        "l_partkey", FLAG, "split", label_map(F.col(FLAG), DISPLAY).alias("target_display"), "l_orderkey", "l_linenumber"])


@query("SELECT doc_id, CAST(n_chars AS VARCHAR) AS n_chars_text FROM documents")
def cleaned_text_values(spark, sf):
    df = read_table(spark, sf, "documents", ["doc_id", "n_chars"])
    padded = F.concat(F.lit(" \t"), F.col("n_chars").cast("string"), F.lit("\n"))
    return df.select("doc_id", clean_text(padded).alias("n_chars_text"))
