"""Correlation, variance inflation and redundancy queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstat.catalog.fixtures import DIMS, FEATURES, SIX, SIX_SQL, WIDE_COLUMNS, rounded, six, wide_columns
from quillstat.catalog.registry import query
from quillstat.operators import collinearity as co
from quillstat.operators import linkage
from quillstat.operators.summaries import histogram


def _pairs_sql(source: str, features: list[str], target: str) -> str:
    spots = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    parts = [f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, corr({a}, {b}) AS correlation FROM {source}" for a, b in spots]
    return f"{target} AS (SELECT *, abs(correlation) AS abs_correlation FROM ({' UNION ALL '.join(parts)}))"


def _matrix_pairs_sql(target: str) -> str:
    """All 2016 correlations of the vectors from one join of moments."""
    return f"""
v AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS x FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings)),
{target} AS (
  SELECT 'e' || lpad(CAST(a.i - 1 AS VARCHAR), 2, '0') AS feature_1,
         'e' || lpad(CAST(b.i - 1 AS VARCHAR), 2, '0') AS feature_2,
         corr(a.x, b.x) AS correlation, abs(corr(a.x, b.x)) AS abs_correlation
  FROM v a JOIN v b ON a.vec_id = b.vec_id AND a.i < b.i GROUP BY a.i, b.i)"""


SIX_PAIRS = SIX_SQL + "," + _pairs_sql("s", SIX, "q")
WIDE_PAIRS = "WITH " + _matrix_pairs_sql("q").strip()


def six_pairs(spark, sf):
    return co.pair_correlations(six(spark, sf), SIX)


def wide_pairs(spark, sf):
    return co.pair_correlations(wide_columns(spark, sf), DIMS, undefined=0.0)


@query(f"""WITH {SIX_PAIRS}
SELECT feature_1, feature_2, round(correlation, 8) AS correlation, round(abs_correlation, 8) AS abs_correlation FROM q""")
def correlation_pairs(spark, sf):
    return rounded(six_pairs(spark, sf), 8, "correlation", "abs_correlation")


@query(f"""{WIDE_PAIRS}
SELECT feature_1, feature_2, round(correlation, 8) AS correlation, round(abs_correlation, 8) AS abs_correlation FROM q""")
def correlation_pairs_wide(spark, sf):
    return rounded(wide_pairs(spark, sf), 8, "correlation", "abs_correlation")


_GAPS = ", ".join(f"CASE WHEN (vec_id + {i}) % 7 <> 0 THEN CAST(embedding[{i + 1}] AS DOUBLE) END AS {n}" for i, n in enumerate(DIMS))


def _with_gaps(spark, sf):
    """wide_columns without every seventh value, so that each pair has rows of its own."""
    df = wide_columns(spark, sf)
    return df.select(*[F.when((F.col("vec_id") + i) % 7 != 0, F.col(n)).alias(n) for i, n in enumerate(DIMS)])


def _gap_pairs_sql(count):
    picked = ", ".join(DIMS[:count])
    return f"""WITH g AS (SELECT vec_id, {_GAPS} FROM embeddings),
l AS (UNPIVOT (SELECT vec_id, {picked} FROM g) ON {picked} INTO NAME f VALUE v)
SELECT a.f AS feature_1, b.f AS feature_2, round(corr(a.v, b.v), 8) AS correlation, round(abs(corr(a.v, b.v)), 8) AS abs_correlation
FROM l a JOIN l b ON a.vec_id = b.vec_id AND a.f < b.f GROUP BY 1, 2"""


@query(_gap_pairs_sql(24))
def correlation_pairs_with_gaps_24(spark, sf):
    return rounded(co.pair_correlations(_with_gaps(spark, sf), DIMS[:24]), 8, "correlation", "abs_correlation")


@query(_gap_pairs_sql(25))
def correlation_pairs_with_gaps_25(spark, sf):
    return rounded(co.pair_correlations(_with_gaps(spark, sf), DIMS[:25]), 8, "correlation", "abs_correlation")


@query(f"""WITH {SIX_PAIRS},
m AS (SELECT feature_1 AS feature, feature_2 AS other, correlation FROM q
      UNION ALL SELECT feature_2, feature_1, correlation FROM q
      UNION ALL SELECT f, f, 1.0 FROM (SELECT unnest({SIX!r}) AS f))
SELECT feature, other, round(correlation, 8) AS correlation FROM m""")
def correlation_matrix(spark, sf):
    return rounded(co.full_matrix(six_pairs(spark, sf), SIX), 8, "correlation")


@query(f"""WITH {SIX_PAIRS}
SELECT feature_1, feature_2, round(correlation, 8) AS correlation, round(abs_correlation, 8) AS abs_correlation
FROM q WHERE abs_correlation >= 0.8""")
def high_correlation_pairs(spark, sf):
    return rounded(co.high_pairs(six_pairs(spark, sf)), 8, "correlation", "abs_correlation")


@query(f"""{WIDE_PAIRS}
SELECT feature_1, feature_2, round(correlation, 8) AS correlation, round(abs_correlation, 8) AS abs_correlation
FROM q ORDER BY q.abs_correlation DESC, feature_1, feature_2 LIMIT 200""")
def top_correlation_pairs(spark, sf):
    return rounded(co.top_pairs(wide_pairs(spark, sf)), 8, "correlation", "abs_correlation")


_THRESHOLDS = (0.02, 0.05, 0.1, *co.WIDE_PAIR_THRESHOLDS)


@query(f"""{WIDE_PAIRS},
h(t) AS (VALUES {", ".join(f"(CAST({t} AS DOUBLE))" for t in _THRESHOLDS)})
SELECT t AS abs_correlation_threshold, count(*) FILTER (abs_correlation >= t) AS n_pairs,
       round(count(*) FILTER (abs_correlation >= t) / CAST(count(*) AS DOUBLE), 8) AS pct_pairs
FROM q CROSS JOIN h GROUP BY t""")
def correlation_threshold_counts(spark, sf):
    return rounded(co.threshold_counts(wide_pairs(spark, sf), _THRESHOLDS), 8, "pct_pairs")


_SUMMARY = """
b AS (SELECT feature_1 AS feature, abs_correlation AS r FROM q UNION ALL SELECT feature_2, abs_correlation FROM q),
cs AS (SELECT feature, avg(r) AS mean_abs_correlation, median(r) AS median_abs_correlation, max(r) AS max_abs_correlation,
              count(*) FILTER (r >= 0.7) AS n_corr_ge_0_70, count(*) FILTER (r >= 0.8) AS n_corr_ge_0_80,
              count(*) FILTER (r >= 0.9) AS n_corr_ge_0_90 FROM b GROUP BY 1)"""
_R = ("mean_abs_correlation", "median_abs_correlation", "max_abs_correlation")


@query(f"""{WIDE_PAIRS}, {_SUMMARY}
SELECT * REPLACE ({", ".join(f"round({c}, 8) AS {c}" for c in _R)}) FROM cs""")
def correlation_summary(spark, sf):
    return rounded(co.correlation_summary(wide_pairs(spark, sf)), 8, *_R)


@query(f"""{WIDE_PAIRS}
SELECT round(max(abs_correlation), 8) AS max_abs_correlation, round(avg(abs_correlation), 8) AS mean_abs_correlation,
       round(median(abs_correlation), 8) AS median_abs_correlation, count(*) AS n_pairs FROM q""")
def correlation_overview(spark, sf):
    return rounded(co.correlation_overview(wide_pairs(spark, sf)), 8, *_R)


@query(f"""{WIDE_PAIRS}, r AS (SELECT min(abs_correlation) AS lo, max(abs_correlation) AS hi FROM q)
SELECT CAST(least(floor((abs_correlation - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS n FROM q, r GROUP BY 1""")
def correlation_histogram(spark, sf):
    return histogram(wide_pairs(spark, sf), F.col("abs_correlation"), 30)


def _vif_sql(a: str, b: str, c: str) -> str:
    """R2 of three features on one another, from the 3 x 3 closed form."""
    def row(x, y, z):
        return (f"SELECT '{x}' AS feature, 1 - (1 + 2*r_{a}_{b}*r_{a}_{c}*r_{b}_{c} - r_{a}_{b}**2 - r_{a}_{c}**2 - r_{b}_{c}**2)"
                f" / (1 - r_{y}_{z}**2) AS r2 FROM z")
    return f"""
z AS (SELECT corr({a}, {b}) AS r_{a}_{b}, corr({a}, {c}) AS r_{a}_{c}, corr({b}, {c}) AS r_{b}_{c} FROM s),
v0 AS ({row(a, b, c)} UNION ALL {row(b, a, c)} UNION ALL {row(c, a, b)}),
v1 AS (SELECT feature, r2, CASE WHEN 1 - r2 <= 1e-12 THEN CAST('inf' AS DOUBLE) ELSE 1 / (1 - r2) END AS vif FROM v0)"""


_THREE = ["l_quantity", "l_extendedprice", "l_tax"]


@query(f"""WITH {SIX_SQL}, {_vif_sql(*_THREE)}
SELECT feature, round(r2, 8) AS r2_against_other_features, round(vif, 6) AS vif, round(1 - 1 / vif, 8) AS partial_r2,
       CASE WHEN vif >= 10 THEN 'strong' WHEN vif >= 5 THEN 'warning' ELSE 'ok' END AS vif_flag FROM v1""")
def vif_table(spark, sf):
    out = co.vif_table(six(spark, sf), _THREE)
    return rounded(rounded(out, 8, "r2_against_other_features", "partial_r2"), 6, "vif")


_CLOSE = ["l_extendedprice", "l_net", "l_quantity"]


@query(f"WITH {SIX_SQL}, {_vif_sql(*_CLOSE)} SELECT feature, round(vif, 5) AS vif FROM v1 WHERE vif >= 5")
def high_vif_features(spark, sf):
    return rounded(co.high_vif(co.vif_table(six(spark, sf), _CLOSE)), 5, "vif").select("feature", "vif")


@query()
def vif_table_six(spark, sf):
    return co.vif_table(six(spark, sf), SIX)


@query()
def vif_capped(spark, sf):
    return co.capped_vif(co.vif_table(wide_columns(spark, sf), DIMS))


@query(f"""WITH {SIX_PAIRS}
SELECT feature_1, feature_2, 1 - abs_correlation < 0.2 AS close FROM q""")
def feature_distance_flags(spark, sf):
    return six_pairs(spark, sf).select("feature_1", "feature_2", (1 - F.col("abs_correlation") < 0.2).alias("close"))


@query()
def feature_clusters(spark, sf):
    return linkage.feature_clusters(six_pairs(spark, sf), SIX)


@query()
def feature_cluster_overview(spark, sf):
    return co.cluster_overview(linkage.feature_clusters(six_pairs(spark, sf), SIX))


@query()
def redundant_feature_candidates(spark, sf):
    df = six(spark, sf)
    pairs = co.pair_correlations(df, SIX)
    return co.redundancy_candidates(
        co.correlation_summary(pairs), co.vif_table(df, SIX), linkage.feature_clusters(pairs, SIX))


@query(f"""WITH {SIX_SQL}, {_pairs_sql("s", _CLOSE, "q")}, {_vif_sql(*_CLOSE)}, {_SUMMARY},
d AS (SELECT feature_1, feature_2, 1 - abs_correlation AS d FROM q),
k AS (SELECT f AS feature, CASE
        WHEN (SELECT max(d) FROM d) <= 0.2 THEN 3
        WHEN (SELECT min(d) FROM d) <= 0.2 AND f IN (SELECT unnest([feature_1, feature_2]) FROM d ORDER BY d.d LIMIT 2) THEN 2
        ELSE 1 END AS cluster_size FROM (SELECT unnest({_CLOSE!r}) AS f)),
r AS (SELECT cs.feature, n_corr_ge_0_80, n_corr_ge_0_90, vif, cluster_size,
             n_corr_ge_0_80 + 2.0 * n_corr_ge_0_90 + CASE WHEN vif >= 5 THEN 1 ELSE 0 END
             + CASE WHEN cluster_size > 1 THEN 1 ELSE 0 END AS redundancy_score
      FROM cs JOIN v1 ON cs.feature = v1.feature JOIN k ON cs.feature = k.feature)
SELECT feature, n_corr_ge_0_80, n_corr_ge_0_90, round(vif, 5) AS vif, CAST(cluster_size AS BIGINT) AS cluster_size,
       CAST(redundancy_score AS DOUBLE) AS redundancy_score
FROM r WHERE cluster_size > 1 OR n_corr_ge_0_80 > 0 OR vif >= 5""")
def redundancy_of_three(spark, sf):
    df = six(spark, sf)
    pairs = co.pair_correlations(df, _CLOSE)
    out = co.redundancy_candidates(
        co.correlation_summary(pairs), co.vif_table(df, _CLOSE), linkage.feature_clusters(pairs, _CLOSE))
    return rounded(out, 5, "vif").select(
        "feature", "n_corr_ge_0_80", "n_corr_ge_0_90", "vif", "cluster_size", "redundancy_score")
