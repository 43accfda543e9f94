"""Classifier queries. Optimisers differ in the last digits, so most have no SQL; those that do compare closed forms,
the model without features, and whether the optimality conditions hold."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.catalog.fixtures import DIMS, FEATURES, FLAG, KEYS, PREPARED, prepared, read_table, wide, wide_columns
from quillstat.catalog.registry import query
from quillstat.operators import evaluation as ev
from quillstat.operators import models as mo
from quillstat.operators import paths, prep, sampling, sparsity, structure
from quillstat.session import keep


def _tall(spark, sf):
    """(labels, train, test) of the prepared lineitem features."""
    df = prepared(spark, sf)
    labels = mo.Labels(("A", "N", "R"))
    table = keep(mo.model_table(df, FLAG, FEATURES, labels, [*KEYS, "split"]))
    return labels, table.filter("split = 'train'"), table.filter("split = 'test'")


def _wide(spark, sf, folds: int = 0):
    """(labels, train, test) of the vectors, with balanced weights and folds."""
    df = sampling.with_split(wide(spark, sf), "label", ["vec_id"])
    labels = mo.fit_labels(df, "label")
    train = df.filter("split = 'train'")
    weights = sampling.class_weights(train, "label")
    if folds:
        df = sampling.with_folds(df, "label", ["vec_id"], folds, only=F.col("split") == "train")
    table = mo.model_table(df, "label", "x", labels, ["vec_id", "split", *(["fold"] if folds else [])])
    table = keep(mo.with_balance(table, weights))
    return labels, table.filter("split = 'train'"), table.filter("split = 'test'")


def _both_metrics(name: str, model, labels, train, test) -> DataFrame:
    parts = [
        mo.predictions(model, side, labels).select(F.lit(name).alias("model"), F.lit(s).alias("split"), "y", "pred")
        for s, side in (("train", train), ("test", test))
    ]
    return ev.metrics(reduce(DataFrame.unionByName, parts), "y", "pred", ["model", "split"])


@query()
def baseline_metrics(spark, sf):
    labels, train, test = _tall(spark, sf)
    model, kind = mo.fit_baseline(train, train.count())
    return _both_metrics(kind, model, labels, train, test)


@query()
def baseline_predictions(spark, sf):
    labels, train, test = _tall(spark, sf)
    model, _ = mo.fit_baseline(train, train.count())
    return mo.predictions(model, test, labels, KEYS)


@query()
def baseline_coefficients(spark, sf):
    labels, train, _ = _tall(spark, sf)
    model, kind = mo.fit_baseline(train, train.count())
    return sparsity.extremes_by_class(mo.coefficients(model, spark, kind, FEATURES, labels))


@query()
def baseline_cross_validation(spark, sf):
    df = prepared(spark, sf).filter("split = 'train'")
    folded = sampling.with_folds(df, FLAG, KEYS, mo.FOLDS)
    labels = mo.Labels(("A", "N", "R"))
    table = keep(mo.model_table(folded, FLAG, FEATURES, labels, ["fold"]))
    return mo.cross_validate(table, lambda n: mo.logistic(n, None), labels, mo.FOLDS)


@query()
def ridge_on_expansion(spark, sf):
    """All 2144 second-degree terms, standardised on train, balanced ridge."""
    df = sampling.with_split(wide(spark, sf), "label", ["vec_id"])
    names = prep.expanded_names(DIMS)
    grown = df.withColumn("x", prep.expand_array(F.col("x")))
    labels = mo.fit_labels(df, "label")
    weights = sampling.class_weights(df.filter("split = 'train'"), "label")
    table = mo.model_table(grown, "label", "x", labels, ["split"])
    scaled = keep(mo.with_balance(mo.standardised(table, table.filter("split = 'train'")), weights))
    train, test = scaled.filter("split = 'train'"), scaled.filter("split = 'test'")
    model = mo.logistic(train.count(), mo.RIDGE_C, weighted=True, tol=1e-6).fit(train)
    assert model.numFeatures == len(names)
    return _both_metrics("ridge", model, labels, train, test)


@query()
def lasso_cross_validation(spark, sf):
    df = prepared(spark, sf).filter("split = 'train'")
    folded = sampling.with_folds(df, FLAG, KEYS, mo.FOLDS)
    table = keep(mo.model_table(folded, FLAG, FEATURES, mo.Labels(("A", "N", "R")), ["fold"]))
    found = mo.penalty_search(table, mo.lasso_grid(), mo.FOLDS, 3, refit=False)
    return mo.score_table(found.folds(spark, "LASSO"))


@query()
def lasso_cross_validation_rows(spark, sf):
    """A row per penalty and fold, with what the solver needed and how many coefficients stay."""
    df = prepared(spark, sf).filter("split = 'train'")
    folded = sampling.with_folds(df, FLAG, KEYS, mo.FOLDS)
    table = mo.model_table(folded, FLAG, FEATURES, mo.Labels(("A", "N", "R")), ["fold"])
    return mo.penalty_search(table, mo.lasso_grid(), mo.FOLDS, 3, refit=False).path_rows(spark, "LASSO")


def _null_slopes(weight: str, source: str) -> str:
    """SQL: mean gradient of the multinomial loss for every class and feature where only the class shares are known."""
    sums = ", ".join(f"sum({weight} * {f}) AS {f}" for f in FEATURES)
    cells = " UNION ALL ".join(
        f"SELECT c.{FLAG} AS class, '{f}' AS feature, (c.w / whole.w * whole.{f} - c.{f}) / whole.w AS slope FROM c, whole" for f in FEATURES)
    return f"""c AS (SELECT {FLAG}, sum({weight}) AS w, {sums} FROM {source} GROUP BY 1),
whole AS (SELECT sum({weight}) AS w, {sums} FROM {source}), g AS ({cells})"""


@query(f"""WITH {PREPARED}, {_null_slopes('1', "(SELECT * FROM tp WHERE split = 'train')")}
SELECT class, feature, round(slope, 8) AS slope, round(max(abs(slope)) OVER (), 8) AS first_penalty FROM g""")
def lasso_first_penalty(spark, sf):
    """Gradient of the model without features, and the least penalty that keeps all coefficients at zero."""
    labels, train, _ = _tall(spark, sf)
    solver = paths.PathSolver(train, 3, [paths.Point(1.0, 1.0)])
    slopes, most = solver.bare_slope[0], float(solver.scale[0])
    solver.close()
    rows = [(c, f, float(slopes[k, j])) for k, c in enumerate(labels.names) for j, f in enumerate(FEATURES)]
    return spark.createDataFrame(rows, "class string, feature string, slope double").select(
        "class", "feature", F.round("slope", 8).alias("slope"), F.round(F.lit(most), 8).alias("first_penalty"))


def _optimality(table: DataFrame, labels: mo.Labels, names: list[str], fits: paths.PathFits) -> DataFrame:
    """(C, l1_ratio, class, feature, coefficient, gap) of fits on all rows of ``table``: by how much each coefficient breaks
    its optimality condition, relative to the largest gradient of the model without features; recomputed from the rows."""
    spark, k = table.sparkSession, len(labels.names)
    n = table.count()
    rows = keep(table.select("label", vector_to_array("features").alias("x")))
    share = {r["label"]: r["count"] / n for r in table.groupBy("label").count().collect()}
    hit = lambda c: (F.col("label") == c).cast("double")
    slope = lambda p, j: F.avg(p * F.col("x")[j])
    null = rows.agg(*[slope(F.lit(share.get(c, 0.0)) - hit(c), j).alias(f"s{c}_{j}") for c in range(k) for j in range(len(names))]).first()
    scale = max(abs(v) for v in null)
    out = []
    for point, b, a in zip(fits.points, fits.coefficients, fits.intercepts):
        margins = [reduce(lambda s, j, c=c: s + F.lit(float(b[c, j])) * F.col("x")[j], range(len(names)), F.lit(float(a[c])))
                   for c in range(k)]
        whole = reduce(lambda s, m: s + F.exp(m), margins[1:], F.exp(margins[0]))
        found = rows.agg(*[slope(F.exp(margins[c]) / whole - hit(c), j).alias(f"s{c}_{j}")
                           for c in range(k) for j in range(len(names))]).first()
        strength = 1.0 / (point.c * n)
        l1, l2 = strength * point.l1_ratio, strength * (1 - point.l1_ratio)
        for c in range(k):
            for j, name in enumerate(names):
                v = float(b[c, j])
                s = found[f"s{c}_{j}"] + l2 * v
                off = abs(s + l1 * np.sign(v)) if v else max(abs(s) - l1, 0.0)
                out.append((point.c, point.l1_ratio, labels.names[c], name, v, float(off / scale)))
    return spark.createDataFrame(out, "C double, l1_ratio double, class string, feature string, coefficient double, gap double")


_PATH_C, _PATH_RATIOS = (0.001, 0.01, 0.1, 10.0), (0.5, 1.0)


@query(f"""SELECT CAST(c AS DOUBLE) AS C, CAST(r AS DOUBLE) AS l1_ratio, class, feature, true AS optimal
FROM (SELECT unnest({list(_PATH_C)}) AS c), (SELECT unnest({list(_PATH_RATIOS)}) AS r), (SELECT DISTINCT {FLAG} AS class FROM lineitem),
  (SELECT unnest({FEATURES}) AS feature)""")
def path_optimality(spark, sf):
    """Whether every coefficient of a penalty path meets its optimality condition within 1e-4, recomputed from the rows."""
    labels, train, _ = _tall(spark, sf)
    points = [paths.Point(c, r) for c in _PATH_C for r in _PATH_RATIOS]
    solver = paths.PathSolver(train, 3, points)
    table = _optimality(train, labels, FEATURES, solver.solve())
    solver.close()
    return table.select("C", "l1_ratio", "class", "feature", (F.col("gap") < 1e-4).alias("optimal"))


@query(f"""SELECT l_linenumber, {FLAG} AS class, round(n / sum(n) OVER (PARTITION BY l_linenumber), 3) AS probability
FROM (SELECT l_linenumber, {FLAG}, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
def one_hot_baseline(spark, sf):
    """Unpenalised model on the indicators of one column: its probabilities are the class shares of each value."""
    df = read_table(spark, sf, "lineitem", [FLAG, "l_linenumber"])
    values = [r[0] for r in df.select("l_linenumber").distinct().orderBy("l_linenumber").collect()]
    marked = df.select(FLAG, "l_linenumber", *[(F.col("l_linenumber") == v).cast("double").alias(f"m{i}") for i, v in enumerate(values)])
    labels = mo.fit_labels(df, FLAG)
    table = keep(mo.model_table(marked, FLAG, [f"m{i}" for i in range(len(values))], labels, ["l_linenumber"]))
    model, _ = mo.fit_baseline(table, table.count())
    guess = mo.predictions(model, table.dropDuplicates(["l_linenumber"]), labels, ["l_linenumber"])
    shares = F.explode(F.array(*[F.struct(F.lit(c).alias("class"), F.round(f"prob_{c}", 3).alias("probability")) for c in labels.names]))
    return guess.select("l_linenumber", shares.alias("s")).select("l_linenumber", "s.*")


@query()
def elastic_net_cross_validation(spark, sf):
    labels, train, _ = _wide(spark, sf, mo.WIDE_FOLDS)
    grid = mo.elastic_net_grid(mo.WIDE_C_GRID, mo.WIDE_L1_RATIOS, weighted=True)
    found = mo.penalty_search(train, grid, mo.WIDE_FOLDS, len(labels.names), True, refit=False)
    return mo.score_table(found.folds(spark, "Elastic Net"))


@query()
def lasso_sparsity(spark, sf):
    labels, train, _ = _wide(spark, sf, mo.WIDE_FOLDS)
    found = mo.penalty_search(train, mo.lasso_grid(mo.WIDE_C_GRID, weighted=True), mo.WIDE_FOLDS, len(labels.names), True)
    return sparsity.by_model(mo.coefficients(found.model, spark, "LASSO", DIMS, labels))


@query()
def post_selection_metrics(spark, sf):
    """LASSO at one penalty picks the features; a plain logistic model is fitted on them."""
    labels, train, test = _wide(spark, sf)
    n = train.count()
    lasso = mo.logistic(n, 0.5, 1.0, weighted=True, tol=1e-6).fit(train)
    coefs = mo.coefficients(lasso, spark, "LASSO", DIMS, labels)
    active = [r["feature"] for r in sparsity.active_features(coefs, "LASSO").collect()]
    model = mo.fit_post_selection(train, DIMS, active, n, weighted=True)
    return _both_metrics("post_selection", model, labels, train, test)


@query()
def linear_svm_metrics(spark, sf):
    labels, train, test = _wide(spark, sf)
    return _both_metrics("linear_svm", mo.linear_svm(train.count()).fit(train), labels, train, test)


@query()
def kernel_svm_metrics(spark, sf):
    labels, train, test = _wide(spark, sf)
    gamma = mo.fourier_scale(train)
    near, far = keep(mo.with_fourier(train, gamma)), mo.with_fourier(test, gamma)
    return _both_metrics("rbf_svm", mo.linear_svm(train.count()).fit(near), labels, near, far)


@query()
def random_forest_metrics(spark, sf):
    labels, train, test = _wide(spark, sf)
    return _both_metrics("random_forest", mo.random_forest().fit(train.repartition(spark.sparkContext.defaultParallelism)), labels, train, test)


@query()
def classifier_comparison(spark, sf):
    from quillstat.plans.alternatives import compare_classifiers

    df = sampling.with_split(wide_columns(spark, sf), "label", ["vec_id"])
    return compare_classifiers(df, "vec_id", "label", DIMS)["test_comparison"]


@query()
def cluster_target_metrics(spark, sf):
    """k-means labels as the class to predict."""
    df = sampling.with_split(wide(spark, sf), "label", ["vec_id"])
    fit = structure.kmeans_sweep(df.filter("split = 'train'"), "x", [structure.CLASS_COUNT])[structure.CLASS_COUNT]
    marked = df.withColumn("cluster", structure.nearest_centre(F.col("x"), fit.centres).cast("string"))
    labels = mo.Labels(tuple(str(i) for i in range(structure.CLASS_COUNT)))
    table = keep(mo.model_table(marked, "cluster", "x", labels, ["split"]))
    train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
    return _both_metrics("cluster_target", mo.logistic(train.count()).fit(train), labels, train, test)
