"""Feature screening queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstat.catalog.fixtures import (
    DIMS, FEATURES, FLAG, KEYS, PREPARED, SIX, SIX_SQL, WIDE_LONG, prepared, rounded, six, wide_columns, wide_long, long_sql,
)
from quillstat.catalog.registry import REGISTRY, query
from quillstat.operators import sampling, screening
from quillstat.operators.moments import feature_moments, training_moments
from quillstat.operators.prep import to_long
from quillstat.session import keep


def _six_long(spark, sf):
    return to_long(six(spark, sf, spread=True), [FLAG], SIX)


def _anova_sql(source: str, target: str) -> str:
    return f"""
{target}_g AS (SELECT feature, y, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM {source} GROUP BY 1, 2),
{target}_h AS (SELECT feature, sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS m FROM {target}_g GROUP BY 1),
{target} AS (
  SELECT g.feature, (sum(g.n * (g.m - h.m) ** 2) / (any_value(h.k) - 1))
                    / (sum(g.n * g.v) / (any_value(h.n) - any_value(h.k))) AS anova_f_score
  FROM {target}_g g JOIN {target}_h h ON g.feature = h.feature GROUP BY 1)"""


def _mi_sql(source: str, target: str) -> str:
    """Nearest-neighbour information by plain windows, one row per data point."""
    by = "PARTITION BY feature, y ORDER BY value"
    gaps = ", ".join(
        f"value - lag(value, {i}) OVER ({by}), lead(value, {i}) OVER ({by}) - value" for i in (1, 2, 3))
    return f"""
{target}_a AS (
  SELECT feature, y, value, row_number() OVER () AS id, count(*) OVER (PARTITION BY feature, y) AS nc, [{gaps}] AS gaps
  FROM {source}),
{target}_b AS (
  SELECT *, list_sort(list_filter(gaps, lambda g: g IS NOT NULL))[CAST(least(3, nc - 1) AS INTEGER)] * (1 - 1e-10) AS d
  FROM {target}_a WHERE nc > 1),
{target}_e AS (
  SELECT feature, id, value AS pos, 1 AS o, 1 AS w, 0 AS s FROM {target}_b
  UNION ALL SELECT feature, id, value - d, 0, 0, -1 FROM {target}_b
  UNION ALL SELECT feature, id, value + d, 2, 0, 1 FROM {target}_b),
{target}_r AS (
  SELECT feature, id, s, sum(w) OVER (PARTITION BY feature ORDER BY pos, o ROWS UNBOUNDED PRECEDING) AS c FROM {target}_e),
{target}_m AS (SELECT feature, id, sum(c * s) AS m FROM {target}_r GROUP BY 1, 2),
{target}_p AS (SELECT b.feature, b.nc, least(3, b.nc - 1) AS k, m.m, count(*) OVER (PARTITION BY b.feature) AS n
               FROM {target}_b b JOIN {target}_m m ON b.feature = m.feature AND b.id = m.id),
{target}_psi AS (
  SELECT j, -0.5772156649015329 + coalesce(sum(CAST(1 AS DOUBLE) / (j - 1)) OVER (ORDER BY j), 0) AS v
  FROM (SELECT unnest(range(1, (SELECT CAST(max(n) + 1 AS BIGINT) FROM {target}_p))) AS j)
  WHERE j > 1 UNION ALL SELECT 1, -0.5772156649015329),
{target} AS (
  SELECT p.feature, greatest(0, any_value(pn.v) + avg(pk.v) - avg(pc.v) - avg(pm.v)) AS mutual_information
  FROM {target}_p p JOIN {target}_psi pn ON pn.j = p.n JOIN {target}_psi pk ON pk.j = p.k
       JOIN {target}_psi pc ON pc.j = p.nc JOIN {target}_psi pm ON pm.j = p.m
  GROUP BY 1)"""


_SIX_LONG = SIX_SQL + "," + long_sql("s", "l", SIX, "l_returnflag AS y")
_WIDE_LABEL = WIDE_LONG + ", wy AS (SELECT feature, label AS y, value FROM wl)"


@query(f"""WITH {_WIDE_LABEL}, {_anova_sql("wy", "f")}
SELECT feature, round(anova_f_score, 6) AS anova_f_score, rank() OVER (ORDER BY anova_f_score DESC) AS anova_rank FROM f""")
def anova_scores_wide(spark, sf):
    out = screening.anova_of(feature_moments(wide_columns(spark, sf), ["label"], DIMS), "label")
    return rounded(out.select("feature", "anova_f_score", "anova_rank"), 6, "anova_f_score")


@query(f"""WITH {_SIX_LONG}, {_mi_sql("l", "mi")}
SELECT feature, round(mutual_information, 6) AS mutual_information,
       rank() OVER (ORDER BY mutual_information DESC) AS mi_rank FROM mi""")
def mutual_information(spark, sf):
    out = screening.mutual_information_of(six(spark, sf, spread=True), FLAG, SIX)
    out = out.withColumn("mi_rank", screening.competition_rank(F.col("mutual_information")))
    return rounded(out, 6, "mutual_information")


@query(f"""WITH {_WIDE_LABEL}, {_mi_sql("wy", "mi")}
SELECT feature, round(mutual_information, 6) AS mutual_information FROM mi""")
def mutual_information_wide(spark, sf):
    out = screening.mutual_information(wide_long(spark, sf), "label")
    return rounded(out.select("feature", "mutual_information"), 6, "mutual_information")


def _logistic(spark, sf):
    """Features are put in units near 1, as after standardisation."""
    df = six(spark, sf, spread=True)
    scaled = df.withColumns({"l_quantity": F.col("l_quantity") / 25, "l_extendedprice": F.col("l_extendedprice") / 40000,
                             "l_net": F.col("l_net") / 40000, "l_unit": F.col("l_unit") / 1500})
    return screening.univariate_logistic(to_long(scaled, [FLAG], SIX), FLAG)


@query()
def univariate_logistic(spark, sf):
    return _logistic(spark, sf)


def _combined(spark, sf):
    rows = keep(_six_long(spark, sf))
    return screening.combine_scores(
        screening.anova_scores(rows, FLAG), screening.mutual_information(rows, FLAG), _logistic(spark, sf))


@query()
def combined_screening(spark, sf):
    return screening.select_screened(_combined(spark, sf))


@query(f"""WITH {_SIX_LONG}, {_anova_sql("l", "f")}, {_mi_sql("l", "mi")},
c AS (SELECT feature, y, avg(value) AS m FROM l GROUP BY 1, 2), g AS (SELECT feature, avg(value) AS m FROM l GROUP BY 1),
x AS (SELECT c.feature, max(abs(c.m - g.m)) AS contrast FROM c JOIN g ON c.feature = g.feature GROUP BY 1),
j AS (SELECT f.feature, anova_f_score AS a, mutual_information AS b, contrast AS c
      FROM f JOIN mi ON f.feature = mi.feature JOIN x ON f.feature = x.feature),
k AS (SELECT feature, a, b, c,
        rank() OVER (ORDER BY a DESC) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
        rank() OVER (ORDER BY b DESC) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb,
        rank() OVER (ORDER BY c DESC) + (count(*) OVER (PARTITION BY c) - 1) / 2.0 AS rc FROM j),
o AS (SELECT *, row_number() OVER (ORDER BY (ra + rb + rc) / 3.0, feature) AS position FROM k)
SELECT feature, round(a, 6) AS anova_f_score, round(b, 6) AS mutual_information, round(c, 6) AS class_mean_contrast,
       round((ra + rb + rc) / 3.0, 8) AS combined_rank, position FROM o WHERE position <= 4""")
def wide_screening(spark, sf):
    out = screening.wide_screening_of(six(spark, sf, spread=True), FLAG, SIX, limit=4)
    out = rounded(out, 6, "anova_f_score", "mutual_information", "class_mean_contrast")
    return rounded(out, 8, "combined_rank").select(
        "feature", "anova_f_score", "mutual_information", "class_mean_contrast", "combined_rank", "position")


# The combination steps on scores that SQL can compute as well: F, contrast, largest value.
_SCORES = WIDE_LONG + """,
wy AS (SELECT feature, label AS y, value FROM wl),""" + _anova_sql("wy", "f") + """,
c AS (SELECT feature, y, avg(value) AS m FROM wy GROUP BY 1, 2), g AS (SELECT feature, avg(value) AS m FROM wy GROUP BY 1),
x AS (SELECT c.feature, max(abs(c.m - g.m)) AS mi FROM c JOIN g ON c.feature = g.feature GROUP BY 1),
lg AS (SELECT feature, -stddev_pop(value) AS ll FROM wy GROUP BY 1),
s AS (SELECT f.feature, round(anova_f_score, 9) AS a, round(mi, 9) AS m, round(ll, 9) AS l
      FROM f JOIN x ON f.feature = x.feature JOIN lg ON f.feature = lg.feature),
nr AS (SELECT *, (a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()) AS an,
         (m - min(m) OVER ()) / (max(m) OVER () - min(m) OVER ()) AS mn,
         (l - min(l) OVER ()) / (max(l) OVER () - min(l) OVER ()) AS ln,
         rank() OVER (ORDER BY a DESC) AS ra, rank() OVER (ORDER BY m DESC) AS rm, rank() OVER (ORDER BY l DESC) AS rl FROM s),
sc AS (SELECT *, CAST(0.4 AS DOUBLE) * an + CAST(0.4 AS DOUBLE) * mn + CAST(0.2 AS DOUBLE) * ln AS score,
              (ra + rm + rl) / 3.0 AS mean_rank FROM nr),
cb AS (SELECT *, rank() OVER (ORDER BY score DESC) AS rc FROM sc)"""


def _sql_scores(spark, sf):
    long = keep(wide_long(spark, sf))
    anova = screening.anova_scores(long, "label").withColumn("anova_f_score", F.round("anova_f_score", 9))
    anova = anova.withColumn("anova_rank", screening.competition_rank(F.col("anova_f_score")))
    mi = screening.class_mean_contrast(wide_columns(spark, sf), "label", DIMS).select(
        "feature", F.round("class_mean_contrast", 9).alias("mutual_information"))
    mi = mi.withColumn("mi_rank", screening.competition_rank(F.col("mutual_information")))
    spread = long.groupBy("feature").agg(F.round(-F.stddev_pop("value"), 9).alias("univariate_logistic_neg_log_loss"))
    spread = spread.withColumn(
        "univariate_logistic_rank", screening.competition_rank(F.col("univariate_logistic_neg_log_loss")))
    return screening.combine_scores(anova, mi, spread)


@query(f"""WITH {_SCORES}
SELECT feature, round(an, 6) AS anova_score_norm, round(mn, 6) AS mi_score_norm, round(ln, 6) AS logistic_score_norm,
       round(score, 6) AS combined_screening_score, round(mean_rank, 6) AS mean_rank, rc AS combined_rank FROM cb""")
def combined_ranking(spark, sf):
    out = _sql_scores(spark, sf).select(
        "feature", "anova_score_norm", "mi_score_norm", "logistic_score_norm", "combined_screening_score", "mean_rank",
        "combined_rank")
    return rounded(out, 6, *out.columns[1:6])


@query(f"""WITH {_SCORES}
SELECT feature, position FROM (
  SELECT feature, row_number() OVER (ORDER BY rc, mean_rank, feature) AS position FROM cb) WHERE position <= 30""")
def selected_features(spark, sf):
    return screening.select_screened(_sql_scores(spark, sf), 30).select("feature", "position")


@query(f"""WITH {_SCORES},
o AS (SELECT row_number() OVER (ORDER BY ra, rc, mean_rank, feature) AS a, row_number() OVER (ORDER BY rm, rc, mean_rank, feature) AS m,
             row_number() OVER (ORDER BY rl, rc, mean_rank, feature) AS l, row_number() OVER (ORDER BY rc, mean_rank, feature) AS c FROM cb),
k(top_k) AS (VALUES (10), (20), (30), (50), (64))
SELECT CAST(top_k AS BIGINT) AS top_k, count(*) FILTER (a <= top_k AND m <= top_k) AS anova_mi_overlap,
       count(*) FILTER (a <= top_k AND l <= top_k) AS anova_logistic_overlap,
       count(*) FILTER (m <= top_k AND l <= top_k) AS mi_logistic_overlap,
       count(*) FILTER (a <= top_k AND m <= top_k AND l <= top_k) AS all_three_overlap,
       count(*) FILTER (c <= top_k AND a <= top_k) AS combined_vs_anova_overlap,
       count(*) FILTER (c <= top_k AND m <= top_k) AS combined_vs_mi_overlap,
       count(*) FILTER (c <= top_k AND l <= top_k) AS combined_vs_logistic_overlap
FROM o CROSS JOIN k GROUP BY 1""")
def screening_overlap(spark, sf):
    return screening.overlap_summary(_sql_scores(spark, sf))


_RANK_COLUMNS = {"anova_rank": "ra", "mi_rank": "rm", "univariate_logistic_rank": "rl", "combined_rank": "rc"}


@query(f"""WITH {_SCORES},
av AS (SELECT {", ".join(f"rank() OVER (ORDER BY {r}) + (count(*) OVER (PARTITION BY {r}) - 1) / 2.0 AS {r}"
                         for r in _RANK_COLUMNS.values())} FROM cb)
{" UNION ALL ".join(f"SELECT '{n}' AS ranking, " + ", ".join(f"round(corr({r}, {q}), 8) AS {m}" for m, q in _RANK_COLUMNS.items()) + " FROM av"
                    for n, r in _RANK_COLUMNS.items())}""")
def rank_agreement(spark, sf):
    return rounded(screening.rank_agreement(_sql_scores(spark, sf)), 8, *_RANK_COLUMNS)


@query(f"""WITH {WIDE_LONG}, a AS (SELECT feature, round(avg(value), 3) AS score FROM wl GROUP BY 1)
SELECT feature, score, rank() OVER (ORDER BY score DESC) AS competition,
       rank() OVER (ORDER BY score DESC) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE) AS average,
       round((rank() OVER (ORDER BY score DESC) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE))
             / count(*) OVER (), 8) AS percentile FROM a""")
def tied_ranks(spark, sf):
    from quillstat.functions.ranking import average_rank, competition_rank, percentile_rank

    means = wide_long(spark, sf).groupBy("feature").agg(F.round(F.avg("value"), 3).alias("score"))
    s = F.col("score")
    return rounded(means.select("feature", "score", competition_rank(s).alias("competition"), average_rank(s).alias("average"),
                                percentile_rank(s).alias("percentile")), 8, "percentile")


@query(REGISTRY["mutual_information"].sql)
def mutual_information_small_bins(spark, sf):
    """Many value ranges per feature, as for a large table."""
    out = screening.mutual_information(_six_long(spark, sf), FLAG, rows_per_bin=2000)
    return rounded(out, 6, "mutual_information")


# Moments and screening inside folds, on the prepared lineitem features.
_FOLDS = 3
_FOLD_LONG = PREPARED + f""",
fr AS (SELECT *, row_number() OVER (PARTITION BY {FLAG} ORDER BY md5(concat_ws('|', '42', {", ".join(KEYS)}))) AS rn,
              count(*) OVER (PARTITION BY {FLAG}) AS nc FROM tp WHERE split = 'train'),
ff AS (SELECT *, CAST(rn > 1 * nc // 3 AS INTEGER) + CAST(rn > 2 * nc // 3 AS INTEGER) AS fold FROM fr),
{long_sql("ff", "fl", FEATURES, f"fold, {FLAG} AS y")},
ho AS (SELECT CAST(h AS INTEGER) AS held_out, fl.y, fl.feature, fl.value
       FROM fl JOIN (SELECT unnest(range(0, {_FOLDS})) AS h) ON fl.fold <> h)"""
_HELD_KEYED = _FOLD_LONG + ", hk AS (SELECT held_out || ':' || feature AS feature, y, value FROM ho)"


def _folded(spark, sf):
    train = prepared(spark, sf).filter("split = 'train'")
    return keep(sampling.with_folds(train, FLAG, KEYS, _FOLDS).select("fold", FLAG, *FEATURES))


@query(f"""WITH {_FOLD_LONG}
SELECT fold, y AS l_returnflag, feature, count(value) AS n, round(avg(value), 7) AS mean, round(var_pop(value) * count(value), 4) AS m2
FROM fl GROUP BY 1, 2, 3""")
def moments_by_fold(spark, sf):
    out = feature_moments(_folded(spark, sf), ["fold", FLAG], FEATURES)
    return rounded(rounded(out, 7, "mean"), 4, "m2")


@query(f"""WITH {_FOLD_LONG}
SELECT held_out, y AS l_returnflag, feature, count(value) AS n, round(avg(value), 7) AS mean,
       round(var_pop(value) * count(value), 4) AS m2
FROM ho GROUP BY 1, 2, 3""")
def training_moments_by_fold(spark, sf):
    """Merged from the moments of the folds; the SQL reads the rows again."""
    out = training_moments(feature_moments(_folded(spark, sf), ["fold", FLAG], FEATURES), _FOLDS, [FLAG])
    return rounded(rounded(out, 7, "mean"), 4, "m2")


@query(f"""WITH {_HELD_KEYED}, {_anova_sql("hk", "f")}
SELECT CAST(split_part(feature, ':', 1) AS INTEGER) AS held_out, split_part(feature, ':', 2) AS feature,
       round(anova_f_score, 6) AS anova_f_score,
       rank() OVER (PARTITION BY split_part(feature, ':', 1) ORDER BY anova_f_score DESC) AS anova_rank FROM f""")
def anova_by_fold(spark, sf):
    moments = training_moments(feature_moments(_folded(spark, sf), ["fold", FLAG], FEATURES), _FOLDS, [FLAG])
    out = screening.anova_of(moments, FLAG, ["held_out"])
    return rounded(out.select("held_out", "feature", "anova_f_score", "anova_rank"), 6, "anova_f_score")


@query(f"""WITH {_HELD_KEYED}, {_anova_sql("hk", "f")}, {_mi_sql("hk", "mi")},
c AS (SELECT feature, y, avg(value) AS m FROM hk GROUP BY 1, 2), g AS (SELECT feature, avg(value) AS m FROM hk GROUP BY 1),
x AS (SELECT c.feature, max(abs(c.m - g.m)) AS contrast FROM c JOIN g ON c.feature = g.feature GROUP BY 1),
j AS (SELECT split_part(f.feature, ':', 1) AS h, split_part(f.feature, ':', 2) AS feature,
             anova_f_score AS a, mutual_information AS b, contrast AS c
      FROM f JOIN mi ON f.feature = mi.feature JOIN x ON f.feature = x.feature),
k AS (SELECT *,
        rank() OVER (PARTITION BY h ORDER BY a DESC) + (count(*) OVER (PARTITION BY h, a) - 1) / 2.0 AS ra,
        rank() OVER (PARTITION BY h ORDER BY b DESC) + (count(*) OVER (PARTITION BY h, b) - 1) / 2.0 AS rb,
        rank() OVER (PARTITION BY h ORDER BY c DESC) + (count(*) OVER (PARTITION BY h, c) - 1) / 2.0 AS rc FROM j),
o AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY (ra + rb + rc) / 3.0, feature) AS position FROM k)
SELECT CAST(h AS INTEGER) AS held_out, feature, round(a, 6) AS anova_f_score, round(b, 6) AS mutual_information,
       round(c, 6) AS class_mean_contrast, round((ra + rb + rc) / 3.0, 8) AS combined_rank, position
FROM o WHERE position <= 3""")
def screening_inside_folds(spark, sf):
    """The three best features of every fold's training rows."""
    out = screening.wide_screening_by_fold(_folded(spark, sf), FLAG, FEATURES, _FOLDS, limit=3)
    out = rounded(out, 6, "anova_f_score", "mutual_information", "class_mean_contrast")
    return rounded(out, 8, "combined_rank").select(
        "held_out", "feature", "anova_f_score", "mutual_information", "class_mean_contrast", "combined_rank", "position")
