"""Baseline, collinearity, screening, regularised models, sparsity and final choice."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.operators import collinearity as co
from quillstat.operators import evaluation as ev
from quillstat.operators import linkage, prep, sampling, screening, sparsity
from quillstat.operators import models as mo
from quillstat.plans.preparation import Prepared
from quillstat.plans.tables import Tables
from quillstat.session import keep


def collinearity_tables(train: DataFrame, features: Sequence[str]) -> Tables:
    """Pairs, thresholds, VIF, clusters and candidates for removal.

    VIF is infinite where the other features explain one fully, as always with more features
    than rows; ``vif_status`` says so.
    """
    pairs = keep(co.pair_correlations(train, features))
    summary = co.correlation_summary(pairs)
    clusters = linkage.feature_clusters(pairs, features)
    vif = co.vif_table(train, features).withColumn("vif_status", co.vif_status(F.lit(train.count()), F.lit(len(features))))
    return {
        "high_correlation_pairs": co.high_pairs(pairs), "correlation_threshold_counts": co.threshold_counts(pairs),
        "correlation_summary": summary, "correlation_overview": co.correlation_overview(pairs), "feature_clusters": clusters,
        "vif": vif, "high_vif": co.high_vif(vif), "redundant_candidates": co.redundancy_candidates(summary, vif, clusters),
    }


def screening_tables(train: DataFrame, y: str, features: Sequence[str], limit: int = screening.MAX_SCREENED) -> tuple[Tables, list[str]]:
    long = keep(prep.to_long(train, [y], features))
    combined = keep(screening.combine_scores(
        screening.anova_scores(long, y), screening.mutual_information(long, y), screening.univariate_logistic(long, y)))
    chosen = screening.select_screened(combined, limit)
    names = [r["feature"] for r in chosen.orderBy("position").select("feature").collect()]
    return {
        "combined_screening": combined, "selected_features": chosen,
        "screening_overlap": screening.overlap_summary(combined), "rank_agreement": screening.rank_agreement(combined),
    }, names


def _modelling_table(prepared: Prepared, key: str, y: str, names: Sequence[str], labels: mo.Labels, folds: int) -> DataFrame:
    both = sampling.with_folds(prepared.data, y, [key], folds, only=F.col("split") == "train")
    return keep(mo.model_table(both, y, list(names), labels, [key, "split", "fold"]))


def pooled(names: Sequence[str], by_fold: dict[int, list[str]]) -> tuple[list[str], dict[int, list[int]]]:
    """All features that the whole training table or any fold has selected, and each fold's positions among them."""
    pool = list(dict.fromkeys([*names, *(f for chosen in by_fold.values() for f in chosen)]))
    place = {f: i for i, f in enumerate(pool)}
    return pool, {fold: [place[f] for f in chosen] for fold, chosen in by_fold.items()}


def supervised(
    prepared: Prepared, key: str, y: str, folds: int = mo.FOLDS, c_grid: Sequence[float] = mo.C_GRID,
    ratios: Sequence[float] = mo.L1_RATIOS, choose_on: str = "cv", parallelism: int = 4,
) -> tuple[Tables, dict]:
    """All result tables and the fitted models of the chain.

    ``choose_on="cv"`` picks the final model by cross-validated macro F1; "test" picks
    by test scores. The winner itself is returned, whichever model it is.

    Cross-validated scores of the selected models come from rows that chose none of their features: every fold is
    screened on its own training rows, and its post-selection model uses what the penalised fits of that fold keep.
    Only the penalty is chosen by the mean over all folds.
    """
    spark = prepared.data.sparkSession
    train_rows = keep(prepared.data.filter("split = 'train'"))
    labels = mo.fit_labels(train_rows, y)
    tables = collinearity_tables(train_rows, prepared.features)
    screened, names = screening_tables(train_rows, y, prepared.features)
    tables |= screened
    folded = keep(sampling.with_folds(train_rows, y, [key], folds))
    screened_by_fold = keep(screening.screening_by_fold(folded, y, prepared.features, folds))
    pool, allowed = pooled(names, screening.features_by_fold(screened_by_fold))
    full = _modelling_table(prepared, key, y, prepared.features, labels, folds)
    slim = _modelling_table(prepared, key, y, names, labels, folds)
    wide = slim if pool == names else _modelling_table(prepared, key, y, pool, labels, folds)
    n = train_rows.count()
    train_of = lambda t: t.filter("split = 'train'")
    baseline, kind = mo.fit_baseline(train_of(full), n)
    cv = mo.cross_validate(train_of(full), lambda m: mo.logistic(m, None), labels, folds)
    lasso, net = (
        mo.penalty_search(train_of(wide), grid, folds, len(labels.names), allowed=allowed, refit_table=train_of(slim))
        for grid in (mo.lasso_grid(c_grid), mo.elastic_net_grid(c_grid, ratios)))
    coefs = keep(
        mo.coefficients(lasso.model, spark, "LASSO", names, labels)
        .unionByName(mo.coefficients(net.model, spark, "Elastic Net", names, labels)))
    order = spark.createDataFrame([(f, i) for i, f in enumerate(names)], "feature string, position int")
    active = [r["feature"] for r in sparsity.selected_union(coefs, order).orderBy("position").collect()]
    post_of = lambda m, chosen: mo.Pipeline(stages=[
        mo.selected_columns(pool, chosen), mo.logistic(m, 1.0).setFeaturesCol("selected")])
    kept = {f: [pool[i] for i in sorted({*lasso.active_in_fold(f), *net.active_in_fold(f)})] or [pool[i] for i in allowed[f]]
            for f in allowed}
    candidate = mo.Candidate({"C": 1.0}, lambda m: post_of(m, active or names), lambda m, f: post_of(m, kept[f]))
    post = mo.search(train_of(wide), [candidate], folds, parallelism)
    fitted = {
        "Baseline multinomial": (baseline, full, len(prepared.features), kind),
        "LASSO": (lasso.model, slim, len(names), "regularized"),
        "Elastic Net": (net.model, slim, len(names), "regularized"),
        "Post-selection Logistic": (post.model, wide, len(active), "post_selection"),
    }
    parts = [
        mo.predictions(model, table, labels, [key, "split"]).select(
            F.lit(name).alias("model"), F.lit(kind_of).alias("model_type"), F.lit(size).alias("n_features"), "*")
        for name, (model, table, size, kind_of) in fitted.items()
    ]
    guesses = keep(reduce(DataFrame.unionByName, parts))
    by = ["model", "model_type", "n_features", "split"]
    scores = ev.class_scores(ev.confusion_cells(guesses, "y", "pred", by), by)
    metrics = keep(ev.metrics_of(scores, by))
    cv_score = {
        "Baseline multinomial": cv.agg(F.avg("macro_f1")).first()[0], "LASSO": lasso.best_score,
        "Elastic Net": net.best_score, "Post-selection Logistic": post.best_score,
    }
    table = metrics.filter("split = 'test'")
    if choose_on == "cv":
        held = spark.createDataFrame(list(cv_score.items()), "model string, cv_macro_f1 double")
        winner = ev.choose_model(table.drop("balanced_accuracy", "accuracy").join(held, "model"), "cv_macro_f1")
    else:
        winner = ev.choose_model(table)
    name = winner.first()["model"]
    tables |= {
        "selected_by_fold": screened_by_fold,
        "post_selection_by_fold": spark.createDataFrame(
            [(f, i, name) for f, chosen in kept.items() for i, name in enumerate(chosen)], "held_out int, position int, feature string"),
        "post_selection_cv": post.folds(spark, "Post-selection Logistic"), "baseline_cv": cv, "baseline_cv_summary": mo.fold_summary(cv),
        "cv_scores": mo.score_table(lasso.folds(spark, "LASSO").unionByName(net.folds(spark, "Elastic Net"))),
        "cv_rows": lasso.path_rows(spark, "LASSO").unionByName(net.path_rows(spark, "Elastic Net")),
        "coefficients": coefs, "sparsity_by_model": sparsity.by_model(coefs), "sparsity_by_class": sparsity.by_class(coefs),
        "active_by_model": sparsity.by_feature(coefs).filter("selected"), "active_by_class": sparsity.active_by_class(coefs),
        "shared_and_specific": sparsity.selection_table(coefs, "LASSO", "Elastic Net"),
        "coefficient_matrix": sparsity.coefficient_matrix(coefs, labels.names),
        "top_coefficients": sparsity.top_coefficients(coefs), "predictions": guesses, "model_comparison": metrics,
        "classification_report": ev.classification_report(scores, by),
        "confusion": ev.confusion_matrix(guesses, "y", "pred", prepared.classes, ["model", "split"]),
        "final_choice": winner,
        "final_predictions": guesses.filter((F.col("model") == name) & (F.col("split") == "test")),
    }
    return tables, {"final": fitted[name][0], **{k: v[0] for k, v in fitted.items()}}
