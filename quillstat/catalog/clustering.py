"""Component, clustering, distance and agreement queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstat.catalog.fixtures import DIMS, WIDE, rounded, split_sql, wide
from quillstat.catalog.registry import REGISTRY, query
from quillstat.functions import ranking
from quillstat.operators import neighbours, structure, summaries
from quillstat.operators.prep import apply_scaling, fit_scaling
from quillstat.operators.sampling import with_split
from quillstat.session import keep
from quillstat.sources.tables import read_table

_PAIR = ["l_quantity", "l_extendedprice"]

LEAVES = 200  # centres under the tree over rows, at every size


def _scaled_pair(spark, sf):
    df = read_table(spark, sf, "lineitem", _PAIR)
    scaled = apply_scaling(df, fit_scaling(df, _PAIR))
    return scaled.select(F.array(*_PAIR).alias("x"))


@query("""
WITH r AS (SELECT abs(corr(l_quantity, l_extendedprice)) AS r FROM lineitem)
SELECT 1 AS pc, round((1 + r) / 2, 8) AS explained, round((1 + r) / 2, 8) AS cumulative FROM r
UNION ALL SELECT 2, round((1 - r) / 2, 8), 1.0 FROM r""")
def pca_variance(spark, sf):
    """Two standardised features, whose shares have the closed form (1 +- |r|) / 2."""
    parts = structure.fit_pca(_scaled_pair(spark, sf), "x", _PAIR, standardised=True)
    return rounded(structure.variance_table(spark, parts), 8, "explained", "cumulative")


@query("""
WITH s AS (SELECT (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS a,
                  (l_extendedprice - avg(l_extendedprice) OVER ()) / stddev_pop(l_extendedprice) OVER () AS b FROM lineitem)
SELECT round((a + b) / sqrt(CAST(2 AS DOUBLE)), 6) AS pc1, round(abs(a - b) / sqrt(CAST(2 AS DOUBLE)), 6) AS pc2_size, count(*) AS n
FROM s GROUP BY 1, 2""")
def pca_scores(spark, sf):
    df = _scaled_pair(spark, sf)
    scored = structure.with_scores(df, "x", structure.fit_pca(df, "x", _PAIR, standardised=True), 2)
    return scored.select(
        F.round(F.col("scores")[0], 6).alias("pc1"), F.round(F.abs(F.col("scores")[1]), 6).alias("pc2_size")
    ).groupBy("pc1", "pc2_size").agg(F.count(F.lit(1)).alias("n"))


@query()
def pca_variance_wide(spark, sf):
    return structure.variance_table(spark, structure.fit_pca(wide(spark, sf), "x", DIMS))


@query()
def pca_component_count(spark, sf):
    parts = structure.fit_pca(wide(spark, sf), "x", DIMS)
    return structure.components_for(structure.variance_table(spark, parts))


@query()
def pca_top_loadings(spark, sf):
    parts = structure.fit_pca(wide(spark, sf), "x", DIMS)
    return structure.top_loadings(structure.loadings_table(spark, parts))


def _reduced(spark, sf, m: int = 10):
    df = wide(spark, sf)
    return structure.with_scores(df, "x", structure.fit_pca(df, "x", DIMS), m).select("vec_id", "label", "scores")


@query()
def kmeans_curve(spark, sf):
    """Inertia and Hartigan index for k = 2..15, best of 20 starts, on ten components."""
    df = keep(_reduced(spark, sf))
    return structure.inertia_table(spark, structure.kmeans_sweep(df, "scores"), df.count())


@query()
def kmeans_crosstab(spark, sf):
    df = keep(_reduced(spark, sf))
    fit = structure.kmeans_sweep(df, "scores", [3])[3]
    marked = df.withColumn("cluster", structure.nearest_centre(F.col("scores"), fit.centres))
    return summaries.cross_table(marked, "cluster", "label", [str(i) for i in range(10)])


@query()
def kmeans_agreement(spark, sf):
    df = keep(_reduced(spark, sf))
    fit = structure.kmeans_sweep(df, "scores", [3])[3]
    marked = df.withColumn("cluster", structure.nearest_centre(F.col("scores"), fit.centres))
    return structure.agreement(marked, "cluster", "label")


@query()
def kmeans_silhouette(spark, sf):
    df = keep(_reduced(spark, sf))
    fits = structure.kmeans_sweep(df, "scores", [2, 3, 4, 5], 5)
    out = None
    for k, fit in fits.items():
        marked = df.withColumn("cluster", structure.nearest_centre(F.col("scores"), fit.centres))
        row = neighbours.average_silhouette(marked, "vec_id", "scores", "cluster").withColumn("k", F.lit(k))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("best_k", F.first("k").over(ranking.W.partitionBy().orderBy(F.desc("silhouette"), "k")))


@query()
def hierarchical_clusters(spark, sf):
    df = keep(_reduced(spark, sf))
    labels = structure.centroid_row_clusters(df, "vec_id", "scores", [3, 14], LEAVES)
    return labels.groupBy("k3", "k14").agg(F.count(F.lit(1)).alias("n"))


# Within-group sums of squares for the grouping "label mod k" stand in for k-means
# inertias, so that SQL can follow the arithmetic over k.
_INERTIA = WIDE + """,
e AS (SELECT k, vec_id, i, x[i] AS v, CAST(label AS INTEGER) % k AS g
      FROM (SELECT *, unnest(range(1, 65)) AS i FROM w) CROSS JOIN (SELECT unnest(range(2, 8)) AS k)),
wk AS (SELECT k, sum(ss) AS inertia FROM (SELECT k, g, i, count(*) * var_pop(v) AS ss FROM e GROUP BY ALL) GROUP BY 1),
hk AS (SELECT k, inertia, (inertia / lead(inertia) OVER (ORDER BY k) - 1) * ((SELECT count(*) FROM w) - k - 1) AS hartigan FROM wk)"""


def _label_inertia(spark, sf):
    df = wide(spark, sf).withColumn("k", F.explode(F.sequence(F.lit(2), F.lit(7))))
    spread = df.select("k", (F.col("label").cast("int") % F.col("k")).alias("g"), F.posexplode("x").alias("i", "v"))
    per = spread.groupBy("k", "g", "i").agg((F.count(F.lit(1)) * F.var_pop("v")).alias("ss"))
    return per.groupBy("k").agg(F.sum("ss").alias("inertia"))


@query(f"WITH {_INERTIA} SELECT CAST(k AS INTEGER) AS k, round(inertia, 6) AS inertia, round(hartigan, 5) AS hartigan FROM hk")
def hartigan_index(spark, sf):
    n = read_table(spark, sf, "embeddings", ["vec_id"]).count()
    out = _label_inertia(spark, sf).withColumn("hartigan", ranking.hartigan(F.col("inertia"), F.col("k"), F.lit(n)))
    return rounded(rounded(out, 6, "inertia"), 5, "hartigan")


@query(f"WITH {_INERTIA} SELECT CAST(arg_max(k, hartigan) AS INTEGER) AS best_k FROM hk")
def best_k_by_hartigan(spark, sf):
    n = read_table(spark, sf, "embeddings", ["vec_id"]).count()
    out = _label_inertia(spark, sf).withColumn("hartigan", ranking.hartigan(F.col("inertia"), F.col("k"), F.lit(n)))
    return ranking.best_k(out.filter("hartigan IS NOT NULL"), "k", "hartigan")


@query(f"""
WITH {WIDE}, v AS (SELECT i, var_samp(x[i]) AS s FROM (SELECT *, unnest(range(1, 65)) AS i FROM w) GROUP BY 1),
r AS (SELECT row_number() OVER (ORDER BY s DESC) AS pc, s / sum(s) OVER () AS share FROM v),
c AS (SELECT pc, sum(share) OVER (ORDER BY pc) AS cumulative FROM r)
SELECT min(pc) AS n_components FROM c WHERE cumulative >= 0.75""")
def axes_for_variance(spark, sf):
    """How many of the raw axes, largest variance first, hold 75 % of it."""
    spread = wide(spark, sf).select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.var_samp("v").alias("s"))
    everything = ranking.W.partitionBy()
    shares = spread.select(
        F.row_number().over(ranking.W.orderBy(F.desc("s"))).alias("pc"), (F.col("s") / F.sum("s").over(everything)).alias("share"))
    table = shares.withColumn("cumulative", ranking.running_total(F.col("share"), F.col("pc")))
    return ranking.first_reaching(table, "pc", "cumulative", structure.VARIANCE_SHARE, "n_components")


@query(f"""
WITH {WIDE},
d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.x, b.x)) AS s, count(*) AS n
      FROM w a CROSS JOIN w b GROUP BY 1, 2, 3),
p AS (SELECT vec_id, label, max(n) FILTER (label = other) AS n,
             max(s / CAST(nullif(n - 1, 0) AS DOUBLE)) FILTER (label = other) AS a, min(s / n) FILTER (label <> other) AS b FROM d GROUP BY 1, 2)
SELECT vec_id, label, round(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END, 8) AS silhouette FROM p""")
def silhouette_rows(spark, sf):
    return rounded(neighbours.silhouette_rows(wide(spark, sf), "vec_id", "x", "label"), 8, "silhouette")


@query(f"""
WITH {WIDE},
d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.x, b.x)) AS s, count(*) AS n
      FROM w a CROSS JOIN w b GROUP BY 1, 2, 3),
p AS (SELECT vec_id, label, max(n) FILTER (label = other) AS n,
             max(s / CAST(nullif(n - 1, 0) AS DOUBLE)) FILTER (label = other) AS a, min(s / n) FILTER (label <> other) AS b FROM d GROUP BY 1, 2)
SELECT round(avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 8) AS silhouette FROM p""")
def average_silhouette(spark, sf):
    return rounded(neighbours.average_silhouette(wide(spark, sf), "vec_id", "x", "label"), 8, "silhouette")


_KNN = WIDE + "," + split_sql("w", "ws", "label", ["vec_id"]) + """,
nn AS (
  SELECT a.vec_id, b.vec_id AS neighbour, b.label, list_distance(a.x, b.x) AS distance,
         row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS rank
  FROM ws a JOIN ws b ON a.split = 'test' AND b.split = 'train' QUALIFY rank <= 5),
vt AS (
  SELECT vec_id, label, sum(CASE WHEN z THEN CASE WHEN distance = 0 THEN 1.0 ELSE 0.0 END ELSE 1 / distance END) AS w
  FROM (SELECT *, min(distance) OVER (PARTITION BY vec_id) = 0 AS z FROM nn) GROUP BY 1, 2),
sh AS (SELECT vec_id, label, w / sum(w) OVER (PARTITION BY vec_id) AS share FROM vt)"""


def _knn_sides(spark, sf):
    df = keep(with_split(wide(spark, sf), "label", ["vec_id"]))
    return df.filter("split = 'test'"), df.filter("split = 'train'")


@query(f"WITH {_KNN} SELECT vec_id, neighbour, label, round(distance, 8) AS distance, CAST(rank AS INTEGER) AS rank FROM nn")
def nearest_neighbours(spark, sf):
    test, train = _knn_sides(spark, sf)
    return rounded(neighbours.nearest_neighbours(test, train, "vec_id", "x", "label"), 8, "distance")


@query(f"""WITH {_KNN},
b AS (SELECT vec_id, label, share, row_number() OVER (PARTITION BY vec_id ORDER BY round(share, 12) DESC, label) AS r FROM sh)
SELECT vec_id, label AS pred, round(share, 8) AS confidence FROM b WHERE r = 1""")
def knn_predictions(spark, sf):
    test, train = _knn_sides(spark, sf)
    return rounded(neighbours.knn_predict(test, train, "vec_id", "x", "label"), 8, "confidence")


@query("""
WITH c AS (SELECT lang AS a, source AS b, count(*) AS n FROM documents GROUP BY 1, 2),
ca AS (SELECT a, sum(n) AS n FROM c GROUP BY 1), cb AS (SELECT b, sum(n) AS n FROM c GROUP BY 1),
t AS (SELECT CAST(sum(n) AS DOUBLE) AS t FROM c),
r AS (SELECT (SELECT sum(n * (n - 1) / 2.0) FROM c) AS both_, (SELECT sum(n * (n - 1) / 2.0) FROM ca) AS ia,
             (SELECT sum(n * (n - 1) / 2.0) FROM cb) AS ib, t * (t - 1) / 2 AS al,
             (SELECT sum(c.n / t * ln(c.n * t / (ca.n * cb.n))) FROM c JOIN ca ON c.a = ca.a JOIN cb ON c.b = cb.b) AS mi,
             (SELECT -sum(n / t * ln(n / t)) FROM ca) AS ha, (SELECT -sum(n / t * ln(n / t)) FROM cb) AS hb FROM t)
SELECT round((both_ - ia * ib / al) / ((ia + ib) / 2 - ia * ib / al), 8) AS adjusted_rand_index,
       round(greatest(mi, 0) / ((ha + hb) / 2), 8) AS normalized_mutual_information FROM r""")
def label_agreement(spark, sf):
    df = read_table(spark, sf, "documents", ["lang", "source"])
    return rounded(structure.agreement(df, "lang", "source"), 8, "adjusted_rand_index", "normalized_mutual_information")


# --- many blocks of rows, as for a large table -----------------------------------------------

@query(REGISTRY["silhouette_rows"].sql)
def silhouette_rows_small_blocks(spark, sf):
    return rounded(neighbours.silhouette_rows(wide(spark, sf), "vec_id", "x", "label", block_rows=64), 8, "silhouette")


@query(REGISTRY["nearest_neighbours"].sql)
def nearest_neighbours_small_blocks(spark, sf):
    test, train = _knn_sides(spark, sf)
    return rounded(neighbours.nearest_neighbours(test, train, "vec_id", "x", "label", block_rows=64), 8, "distance")


@query(f"""
WITH {WIDE},
d AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.x, b.x) ** 2) AS s, count(*) AS n
      FROM w a CROSS JOIN w b GROUP BY 1, 2, 3),
p AS (SELECT vec_id, label, max(n) FILTER (label = other) AS n,
             max(s / CAST(nullif(n - 1, 0) AS DOUBLE)) FILTER (label = other) AS a, min(s / n) FILTER (label <> other) AS b FROM d GROUP BY 1, 2)
SELECT round(avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 8) AS silhouette FROM p""")
def squared_silhouette(spark, sf):
    """The linear form: it needs sums per cluster only."""
    value = neighbours.squared_silhouette(wide(spark, sf), "x", "label")
    rows = read_table(spark, sf, "embeddings", ["vec_id"]).limit(1)
    return rounded(rows.select(F.lit(value).alias("silhouette")), 8, "silhouette")


@query(REGISTRY["nearest_neighbours"].sql)
def nearest_neighbours_by_cells(spark, sf):
    test, train = _knn_sides(spark, sf)
    return rounded(neighbours.nearest_by_cells(test, train, "vec_id", "x", "label"), 8, "distance")


@query("""
WITH o AS (SELECT o_orderkey, o_orderstatus, o_orderkey % 50 = 0 AS asked, o_totalprice / 1000 AS a, o_custkey / 10 AS b FROM orders
  WHERE o_totalprice IS NOT NULL AND o_custkey IS NOT NULL),
d AS (SELECT q.o_orderkey, p.o_orderkey AS neighbour, p.o_orderstatus, sqrt((q.a - p.a) ** 2 + (q.b - p.b) ** 2) AS distance
  FROM o q JOIN o p ON q.asked AND NOT p.asked),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY distance, neighbour) AS rank FROM d)
SELECT o_orderkey, neighbour, o_orderstatus, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM r WHERE rank <= 5""")
def nearest_orders_by_cells(spark, sf):
    """Nearest orders in two columns, where most cells are skipped."""
    orders = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]).dropna(
        subset=["o_custkey", "o_totalprice"])
    orders = keep(orders.select("o_orderkey", "o_orderstatus", (F.col("o_orderkey") % 50 == 0).alias("asked"), F.array(
        F.col("o_totalprice") / 1000, F.col("o_custkey") / 10).alias("x")))
    found = neighbours.nearest_by_cells(orders.filter("asked"), orders.filter("NOT asked"), "o_orderkey", "x", "o_orderstatus")
    return rounded(found, 6, "distance")
