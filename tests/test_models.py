"""Model settings, tuning and whole plans on small tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstat.operators import evaluation as ev
from quillstat.operators import models as mo
from quillstat.operators import sampling
from quillstat.plans.alternatives import compare_classifiers, forest_candidate
from quillstat.plans.expanded import expanded_chain
from quillstat.plans.preparation import prepare
from quillstat.plans.supervised import supervised
from quillstat.plans.tables import save_tables
from quillstat.plans.unsupervised import unsupervised

NAMES = ["f0", "f1", "f2", "f3"]


def _data(n=150):
    rng = np.random.default_rng(21)
    y = np.array(["noun"] * (n * 2 // 3) + ["verb"] * (n // 5) + ["adjective"] * (n - n * 2 // 3 - n // 5))
    x = rng.normal(size=(n, 4))
    x[:, 0] += (y == "verb") * 1.5
    x[:, 1] -= (y == "adjective") * 1.5
    return x, y


@pytest.fixture(scope="module")
def entries(spark):
    x, y = _data()
    rows = [(i, f"w{i // 2}", str(c), *[None if (i + j) % 37 == 0 else float(v) for j, v in enumerate(p)])
            for i, (p, c) in enumerate(zip(x, y))]
    schema = "entry_id long, word string, target string, " + ", ".join(f"{n} double" for n in NAMES)
    extra = [(900, "zz", " noun ", 0.1, 0.2, 0.3, 0.4), (901, "zz", "pronoun", 0.1, 0.2, 0.3, 0.4), rows[5]]
    return spark.createDataFrame(rows + extra, schema).repartition(3)


def _objective(x, y, c, weights):
    """Minimise 0.5 |w|^2 + c * weighted sum of losses by Newton steps."""
    names = sorted(set(y))
    k, p = len(names), x.shape[1] + 1
    base = np.c_[np.ones(len(x)), x]
    hot = np.array([[float(v == n) for n in names] for v in y])
    w = np.zeros((p, k))
    for _ in range(60):
        z = base @ w
        prob = np.exp(z - z.max(1, keepdims=True))
        prob /= prob.sum(1, keepdims=True)
        grad = c * base.T @ (weights[:, None] * (prob - hot))
        grad[1:] += w[1:]
        hess = np.zeros((p * k, p * k))
        for a in range(k):
            for b in range(k):
                d = weights * prob[:, a] * ((a == b) - prob[:, b])
                hess[a * p : a * p + p, b * p : b * p + p] = c * base.T @ (d[:, None] * base)
            hess[a * p + 1 : a * p + p, a * p + 1 : a * p + p] += np.eye(p - 1)
        w = w - (np.linalg.pinv(hess, rcond=1e-12) @ grad.T.ravel()).reshape(k, p).T
    return w[1:].T


@pytest.mark.parametrize("weighted", [False, True])
def test_penalty_matches_the_sum_of_losses_form(spark, weighted):
    x, y = _data()
    rows = [(str(c), [float(v) for v in p]) for p, c in zip(x, y)]
    df = spark.createDataFrame(rows, "y string, x array<double>")
    labels = mo.fit_labels(df, "y")
    weights = sampling.class_weights(df, "y")
    table = mo.with_balance(mo.model_table(df, "y", "x", labels), weights)
    model = mo.logistic(len(x), 0.5, weighted=weighted, tol=1e-12).fit(table)
    w = np.array([weights[c] if weighted else 1.0 for c in y])
    assert model.coefficientMatrix.toArray() == pytest.approx(_objective(x, y, 0.5, w), abs=1e-4)
    assert labels.names == ("adjective", "noun", "verb")


def test_standardised_vectors_use_train_population_std(spark):
    x, y = _data(60)
    df = spark.createDataFrame([(str(c), [float(v) for v in p]) for p, c in zip(x, y)], "y string, x array<double>")
    table = mo.model_table(df, "y", "x", mo.fit_labels(df, "y"))
    out = np.array([r["features"].toArray() for r in mo.standardised(table, table).collect()])
    assert out.mean(axis=0) == pytest.approx(np.zeros(4), abs=1e-12) and out.std(axis=0) == pytest.approx(np.ones(4))


def test_fourier_features_approach_the_kernel(spark):
    x, y = _data(30)
    df = spark.createDataFrame([(str(c), [float(v) for v in p]) for p, c in zip(x, y)], "y string, x array<double>").coalesce(1)
    table = mo.model_table(df, "y", "x", mo.fit_labels(df, "y"))
    assert mo.fourier_scale(table) == pytest.approx(1 / (4 * x.var()))
    z = np.array([r["features"].toArray() for r in mo.with_fourier(table, 0.1, dims=20_000).collect()])
    kernel = np.exp(-0.1 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - kernel).max() < 0.06


def test_macro_f1_of_cells_equals_table(spark):
    pairs = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")]
    df = spark.createDataFrame(pairs, "y string, pred string")
    cells = [(r["y"], r["pred"], r["n"]) for r in ev.confusion_cells(df, "y", "pred").collect()]
    row = ev.metrics(df, "y", "pred").first()
    assert row["macro_f1"] == pytest.approx(mo.macro_f1(cells))
    fixed = ev.metrics(df, "y", "pred", classes=["a", "b", "c", "d"]).first()
    assert fixed["macro_f1"] == pytest.approx(row["macro_f1"] * 3 / 4)
    assert fixed["balanced_accuracy"] == pytest.approx(row["balanced_accuracy"])


def test_preparation(spark, entries):
    got = prepare(entries, "entry_id", "word", "target", {"noun": "Thing", "verb": "Action", "adjective": "Property"})
    assert got.features == NAMES
    assert got.tables["label_validity"].first()["rows_invalid"] == 1
    assert got.tables["duplicate_count"].first()["duplicates_removed"] == 1
    n = got.data.count()
    assert n == 151 and got.data.filter("split = 'test'").count() == 31
    check = {r["split"]: r for r in got.tables["standardisation_check"].collect()}
    assert check["train"]["max_abs_feature_mean"] < 1e-12 and check["train"]["min_feature_std"] == pytest.approx(1.0)
    assert got.data.filter(" OR ".join(f"{f} IS NULL" for f in NAMES)).count() == 0


def test_supervised_and_expanded_plans(spark, entries, tmp_path):
    display = {"noun": "Thing", "verb": "Action", "adjective": "Property"}
    got = prepare(entries, "entry_id", "word", "target", display)
    tables, fitted = supervised(got, "entry_id", "target", folds=2, c_grid=[0.1, 1.0], ratios=[0.5])
    assert tables["model_comparison"].count() == 8
    assert tables["final_choice"].count() == 1 and fitted["final"] is fitted[tables["final_choice"].first()["model"]]
    assert tables["final_predictions"].count() == 31
    assert tables["cv_scores"].count() == 4 and tables["coefficients"].count() == 24
    save_tables({k: tables[k] for k in ("model_comparison", "vif")}, str(tmp_path))
    assert spark.read.parquet(str(tmp_path / "vif")).count() == 4
    grown = prepare(entries, "entry_id", "word", "target", display, expand=True)
    assert len(grown.features) == 14
    tables, _ = expanded_chain(grown, "entry_id", "target", limit=6, folds=2, c_grid=[1.0], ratios=[0.5], width=14)
    assert tables["metrics"].count() == 10 and tables["selected_features"].count() == 6
    with pytest.raises(ValueError):
        expanded_chain(grown, "entry_id", "target", width=2210)


def test_the_forest_reports_the_limits_it_is_grown_with(spark):
    candidate = forest_candidate(10)
    forest = candidate.build(100)
    assert candidate.params == {"n_estimators": forest.getNumTrees(), "max_depth": forest.getMaxDepth(),
                                "min_samples_leaf": forest.getMinInstancesPerNode()}


def test_comparison_and_unsupervised_plans(spark, entries):
    got = prepare(entries, "entry_id", "word", "target", {"noun": "Thing", "verb": "Action", "adjective": "Property"})
    tables = compare_classifiers(got.data, "entry_id", "target", got.features, folds=2, trees=10, svm_rounds=5)
    assert tables["test_comparison"].count() == 6 and tables["metrics"].count() == 12
    assert tables["predictions"].groupBy("model").count().select("count").distinct().count() == 1
    explored = unsupervised(got.data, "entry_id", "target", got.features, ks=[2, 3], restarts=2)
    assert explored["clusters"].count() == 151 and explored["silhouette_curve"].count() == 4
    assert explored["crosstab_kmeans_k3"].count() == 3
    fast = unsupervised(got.data, "entry_id", "target", got.features, ks=[2, 3], restarts=2, exact_silhouette=False)
    assert fast["silhouette_curve"].filter(F.col("silhouette").between(-1, 1)).count() == 4


def test_threads_have_local_properties_of_their_own(spark):
    """Shared ones made a fit fail now and then: "Cannot parse null string"."""
    from threading import Barrier

    from quillstat.session import side_by_side

    meet = Barrier(4)

    def run(i):
        spark.sparkContext.setLocalProperty("quillstat.mine", str(i))
        meet.wait(30)
        return spark.sparkContext.getLocalProperty("quillstat.mine")

    assert side_by_side(spark, run, range(4), 4) == ["0", "1", "2", "3"]


def test_margins_equal_those_of_one_vs_rest(spark):
    from pyspark.ml.classification import OneVsRest
    from pyspark.ml.linalg import Vectors

    from quillstat.operators.models import linear_svm

    rng = np.random.default_rng(5)
    rows = [(float(i % 3), 1.0 + i % 2, Vectors.dense(rng.normal(size=2) + i % 3)) for i in range(60)]
    table = spark.createDataFrame(rows, ["label", "weight", "features"]).coalesce(1)
    ours = linear_svm(60)
    theirs = OneVsRest(classifier=ours.getClassifier(), weightCol="weight", parallelism=1).fit(table)
    for a, b in zip(ours.fit(table).models, theirs.models):
        assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray())


def test_margins_of_many_classes_share_their_passes(spark):
    from pyspark.ml.linalg import Vectors

    from quillstat.operators.models import linear_svm

    rng = np.random.default_rng(6)
    rows = [(float(i % 6), 1.0, Vectors.dense(rng.normal(size=3) + i % 6)) for i in range(90)]
    table = spark.createDataFrame(rows, ["label", "weight", "features"]).coalesce(1)
    spark.sparkContext.setJobGroup("margins", "margins")
    try:
        linear_svm(90, max_iter=10).fit(table)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("margins"))
    print(jobs, "jobs")
    assert 0 < jobs < 6 * 10  # every class for itself: over 20 passes each
