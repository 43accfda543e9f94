"""The chain on second-degree terms: baselines, correlation, screening, sparse models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.functions.scalars import with_size_guides
from quillstat.operators import collinearity as co
from quillstat.operators import evaluation as ev
from quillstat.operators import models as mo
from quillstat.operators import prep, quality, sampling, screening, sparsity
from quillstat.plans.preparation import Prepared
from quillstat.plans.supervised import pooled
from quillstat.plans.tables import Tables
from quillstat.session import keep


def expanded_chain(
    prepared: Prepared, key: str, y: str, limit: int = screening.WIDE_SCREENED, folds: int = mo.WIDE_FOLDS,
    c_grid: Sequence[float] = mo.WIDE_C_GRID, ratios: Sequence[float] = mo.WIDE_L1_RATIOS, width: int | None = None,
    parallelism: int = 4,
) -> tuple[Tables, dict]:
    """``prepared`` comes from ``prepare(..., expand=True)``; ``width`` enforces its size. Every fold is screened on
    its own training rows, so cross-validated scores come from rows that chose none of the features."""
    spark = prepared.data.sparkSession
    if width is not None:
        quality.check_width(prepared.features, width, strict=True)
    train_rows = keep(prepared.data.filter("split = 'train'"))
    labels = mo.fit_labels(train_rows, y)
    n, p = train_rows.count(), len(prepared.features)
    weights = {str(c): w for c, w in sampling.class_weights(train_rows, y).items()}
    pairs = keep(co.pair_correlations(train_rows, prepared.features, undefined=0.0))
    long = keep(prep.to_long(train_rows, [y], prepared.features))
    chosen = keep(screening.wide_screening(long, y, limit))
    names = [r["feature"] for r in chosen.orderBy("position").select("feature").collect()]
    folded = sampling.with_folds(prepared.data, y, [key], folds, only=F.col("split") == "train")
    folded_train = folded.filter("split = 'train'")
    selected_by_fold = keep(screening.wide_screening_by_fold(folded_train, y, prepared.features, folds, limit))
    pool, allowed = pooled(names, screening.features_by_fold(selected_by_fold))
    shape = lambda cols: keep(mo.with_balance(
        mo.model_table(folded, y, list(cols), labels, [key, "split", "fold"]), weights))
    full, slim = shape(prepared.features), shape(names)
    wide = slim if pool == names else shape(pool)
    train_of = lambda t: t.filter("split = 'train'")
    ridge = mo.logistic(n, mo.RIDGE_C, weighted=True, tol=1e-6).fit(train_of(full))
    lasso, net = (
        mo.penalty_search(train_of(wide), grid, folds, len(labels.names), True, allowed=allowed, refit_table=train_of(slim))
        for grid in (mo.lasso_grid(c_grid, weighted=True), mo.elastic_net_grid(c_grid, ratios, weighted=True)))
    coefs = keep(
        mo.coefficients(lasso.model, spark, "lasso", names, labels)
        .unionByName(mo.coefficients(net.model, spark, "elastic_net", names, labels)))
    best = "lasso" if lasso.best_score >= net.best_score else "elastic_net"
    active = [r["feature"] for r in sparsity.active_features(coefs, best).collect()]
    final = mo.fit_post_selection(train_of(slim), names, active, n, weighted=True)
    fitted = {"ridge": (ridge, full), "lasso": (lasso.model, slim), "elastic_net": (net.model, slim),
              f"post_selection_logistic_from_{best}": (final, slim)}
    parts = [
        mo.predictions(model, table, labels, [key, "split"]).select(F.lit(name).alias("model"), "split", "y", "pred")
        for name, (model, table) in fitted.items()
    ]
    guess = mo.predict_majority(full.select("split", "y"), train_of(full), "y").select(
        F.lit("dummy_majority").alias("model"), "split", "y", F.col("prediction").alias("pred"))
    guesses = keep(reduce(DataFrame.unionByName, [guess, *parts]))
    by = ["model", "split"]
    metrics = ev.metrics(guesses, "y", "pred", by)
    sizes = spark.createDataFrame([(n, p)], "n_observations_train long, n_features_before_screening long")
    tables = {
        "correlation_threshold_counts": co.threshold_counts(pairs, co.WIDE_PAIR_THRESHOLDS),
        "top_correlation_pairs": co.top_pairs(pairs),
        "high_correlation_pairs": co.high_pairs(pairs, co.WIDE_HIGH_PAIR),
        "vif_status": with_size_guides(sizes, "n_observations_train", "n_features_before_screening").withColumn(
            "vif_status", co.vif_status(F.col("n_observations_train"), F.col("n_features_before_screening"))),
        "selected_features": chosen, "selected_by_fold": selected_by_fold, "cv_rows": lasso.path_rows(spark, "lasso").unionByName(net.path_rows(spark, "elastic_net")),
        "coefficients": coefs, "sparsity": sparsity.wide_summary(coefs),
        "sparsity_by_class": sparsity.by_class(coefs),
        "selection_counts": sparsity.selection_counts(sparsity.selection_table(coefs, "lasso", "elastic_net")),
        "coefficient_matrix": sparsity.coefficient_matrix(coefs, labels.names, active_only=True),
        "top_coefficients": sparsity.top_by_class(coefs), "metrics": metrics, "metrics_wide": ev.metrics_wide(metrics),
        "confusion": ev.confusion_matrix(guesses, "y", "pred", prepared.classes, by), "predictions": guesses,
    }
    return tables, {"final": final, "ridge": ridge, "lasso": lasso.model, "elastic_net": net.model}
