"""Results that are published with the analysis this engine rebuilds.

Fixed values: confusion counts, contingency tables and score lists as published,
with the published figures derived from them.
"""

import json

import pytest
from pyspark.sql import functions as F

from quillstat.operators import evaluation as ev
from quillstat.operators import models as mo
from quillstat.operators import screening, sparsity, structure
from quillstat.operators.sampling import split_quotas

CLASSES = ["Thing", "Action", "Property"]
CONFUSIONS = {
    "baseline": ([[84, 1, 2], [0, 11, 1], [1, 0, 7]],
                 {"accuracy": 0.9532710280373832, "balanced_accuracy": 0.9190613026819924, "macro_precision": 0.8683006535947712,
                  "macro_recall": 0.9190613026819924, "macro_f1": 0.8903962101636519, "weighted_precision": 0.9586586036283673,
                  "weighted_recall": 0.9532710280373832, "weighted_f1": 0.9551305271800816}),
    "post_selection": ([[86, 0, 1], [0, 11, 1], [1, 0, 7]],
                       {"accuracy": 0.9719626168224299, "balanced_accuracy": 0.9267241379310344,
                        "macro_precision": 0.9220945083014049, "macro_f1": 0.9228522993405258, "weighted_f1": 0.9725840762961016}),
    "k_nn": ([[87, 0, 0], [2, 10, 0], [3, 0, 5]],
             {"accuracy": 0.9532710280373832, "balanced_accuracy": 0.8194444444444445, "macro_precision": 0.9818840579710145,
              "macro_f1": 0.8834629058092746, "weighted_precision": 0.9558106460788297, "weighted_f1": 0.9498389669642215}),
    "random_forest": ([[87, 0, 0], [0, 12, 0], [2, 0, 6]],
                      {"accuracy": 0.9813084112149533, "balanced_accuracy": 0.9166666666666666,
                       "macro_precision": 0.9925093632958801, "macro_f1": 0.9485930735930737, "weighted_f1": 0.9800794999393131}),
    "dummy": ([[87, 0, 0], [12, 0, 0], [8, 0, 0]],
              {"balanced_accuracy": 0.3333333333333333, "macro_precision": 0.27102803738317754, "macro_f1": 0.29896907216494845,
               "weighted_precision": 0.6611057734299939, "weighted_f1": 0.72926100780422}),
}


def test_metrics(spark):
    rows = [(m, CLASSES[i], CLASSES[j], n) for m, (t, _) in CONFUSIONS.items() for i, r in enumerate(t) for j, n in enumerate(r) if n]
    cells = spark.createDataFrame(rows, "model string, y string, pred string, n long")
    got = {r["model"]: r for r in ev.metrics_of(ev.class_scores(cells, ["model"]), ["model"]).collect()}
    for model, (_, published) in CONFUSIONS.items():
        for metric, value in published.items():
            assert got[model][metric] == pytest.approx(value, abs=1e-12), (model, metric)


@pytest.mark.parametrize("table, ari, nmi", [
    ([[10, 5, 52], [39, 12, 132], [1, 14, 163]], 0.0301, 0.0720),
    ([[8, 5, 45], [0, 0, 55], [42, 26, 247]], -0.0667, 0.0425),
])
def test_agreement(spark, table, ari, nmi):
    rows = [(i, j, n) for i, r in enumerate(table) for j, n in enumerate(r)]
    got = structure.agreement_of(spark.createDataFrame(rows, "a int, b int, n long")).first()
    assert tuple(got) == (pytest.approx(ari, abs=5e-5), pytest.approx(nmi, abs=5e-5))


@pytest.mark.parametrize("f, p", [
    (55.6160470251545, 3.5089478407881443e-22), (47.99478057802536, 1.6087203016761235e-19), (44.75121834607276, 2.3057780508026196e-18)])
def test_anova_probability(f, p):
    assert screening._beta_tail(f, 2, 425) == pytest.approx(p, rel=1e-10)
    assert (1 + 2 * f / 425) ** (-425 / 2) == pytest.approx(p, rel=1e-10)


def test_split_quotas():
    assert split_quotas({"noun": 434, "verb": 62, "adjective": 39}) == {"noun": 87, "verb": 12, "adjective": 8}


def test_combined_score():
    weights = screening.SCORE_WEIGHTS
    score = sum(w * v for w, v in zip(weights.values(), (0.8627291075404325, 0.3392548640019921, 1.0)))
    assert score == pytest.approx(0.6807935886169698)


def test_choice_of_model(spark):
    rows = [("LASSO", 0.8903962101636519, 0.9190613026819924, 0.953, 65), ("Elastic Net", 0.8903962101636519, 0.9190613026819924, 0.953, 65),
            ("Post-selection Logistic", 0.9228522993405258, 0.9267241379310344, 0.972, 65)]
    table = spark.createDataFrame(rows, "model string, macro_f1 double, balanced_accuracy double, accuracy double, n_features int")
    assert ev.choose_model(table.withColumn("split", F.lit("test")), split="test").first()["model"] == "Post-selection Logistic"
    assert ev.choose_model(table.filter("model <> 'Post-selection Logistic'")).first()["model"] == "Elastic Net"


def test_best_penalty_from_fold_scores(spark):
    # first fold of the published path: the weakest penalty scores best
    path = [0.29677419354838713] * 3 + [0.45647773279352233, 0.6830140485312898, 0.7145539906103288, 0.7059961315280464,
                                        0.7145539906103288, 0.7145539906103288, 0.7713303245218138]
    rows = [("LASSO", json.dumps({"C": c}), 0, 1.0, s) for c, s in zip(mo.C_GRID, path)]
    folds = spark.createDataFrame(rows, "model string, params string, fold int, train_score double, test_score double")
    best = mo.score_table(folds).filter("rank_test_score = 1").collect()
    assert [json.loads(r["params"])["C"] for r in best] == [pytest.approx(100.0)]
    assert mo.C_GRID[1] == pytest.approx(0.003593813663804626)


def test_sparsity_counts(spark):
    # 195 coefficients over 65 features and 3 classes with 50, 60 and 62 nonzero
    rows = [("LASSO", c, f"f{i:02d}", 0.5 if i < n else 0.0) for c, n in (("Action", 50), ("Property", 60), ("Thing", 62)) for i in range(65)]
    coefs = sparsity.with_flags(spark.createDataFrame(rows, "model string, class string, feature string, coefficient double"))
    row = sparsity.by_model(coefs).first()
    assert (row["total_coefficients"], row["nonzero_coefficients"], row["zero_share"]) == (195, 172, pytest.approx(0.11794871794871795))
    assert {r["class"]: r["nonzero_coefficients"] for r in sparsity.by_class(coefs).collect()} == {"Action": 50, "Property": 60, "Thing": 62}


def test_selected_union_of_models_without_features_is_empty(spark, tmp_path):
    """As its SQL says; a plan that needs features may ask for all of them."""
    from quillstat.catalog import load_all

    rows = [(i, [0.1] * 64, i % 10) for i in range(40)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert load_all()["selected_union"].run(spark, str(tmp_path)).count() == 0
    coefs = sparsity.with_flags(spark.createDataFrame([("m", "c", "f", 0.0)], "model string, class string, feature string, coefficient double"))
    order = spark.createDataFrame([("f", 0), ("g", 1)], "feature string, position int")
    assert sparsity.selected_union(coefs, order).count() == 2
