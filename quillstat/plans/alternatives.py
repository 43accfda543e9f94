"""Six classifiers side by side: tuned by macro F1 on folds, compared on test rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstat.operators import evaluation as ev
from quillstat.operators import models as mo
from quillstat.operators import neighbours, sampling
from quillstat.operators.quality import require_features, require_numeric
from quillstat.session import cut_lineage, keep

DUMMY, LOGISTIC, LINEAR, KERNEL, FOREST, KNN = (
    "Dummy majority", "Post-selection Logistic", "SVM linear", "SVM RBF", "Random Forest", "k-NN")


def compare_classifiers(
    df: DataFrame, key: str, y: str, features: Sequence[str], folds: int = mo.WIDE_FOLDS, parallelism: int = 4,
    trees: int = mo.TREES, svm_rounds: int = 100,
) -> dict[str, DataFrame]:
    """Tables ``predictions``, ``metrics``, ``best_params``, ``cv_scores``, ``reports`` and
    ``test_comparison`` from a table with a ``split`` column."""
    spark = df.sparkSession
    train_rows, test_rows = df.filter("split = 'train'"), df.filter("split = 'test'")
    require_features(train_rows, test_rows, features)
    require_numeric(df, features)
    labels = mo.fit_labels(df, y)
    weights = sampling.class_weights(train_rows, y)
    marked = sampling.with_folds(df, y, [key], folds, only=F.col("split") == "train")
    table = keep(mo.with_balance(
        mo.model_table(marked, y, list(features), labels, [key, "split", "fold"]), {str(c): w for c, w in weights.items()}))
    train, test = table.filter("split = 'train'"), table.filter("split = 'test'")
    gamma = mo.fourier_scale(train)
    curved = keep(mo.with_fourier(table, gamma))
    runs = {
        LOGISTIC: (train, test, [mo.Candidate({"C": 1.0}, lambda n: mo.logistic(n, 1.0, weighted=True, tol=1e-6))]),
        LINEAR: (train, test, [mo.Candidate({"C": 1.0}, lambda n: mo.linear_svm(n, 1.0, svm_rounds))]),
        KERNEL: (curved.filter("split = 'train'"), curved.filter("split = 'test'"),
                 [mo.Candidate({"C": 1.0, "gamma": "scale"}, lambda n: mo.linear_svm(n, 1.0, svm_rounds))]),
        FOREST: (train, test, [forest_candidate(trees)]),
    }
    found: dict[str, mo.Search | None] = {DUMMY: None}
    parts = []
    guess = mo.predict_majority(table.select("split", "y"), train, "y")
    parts.append(guess.select(F.lit(DUMMY).alias("model"), "split", "y", F.col("prediction").alias("pred")))
    for name, (near, far, grid) in runs.items():
        found[name] = mo.search(near, grid, folds, parallelism)
        for s, side in (("train", near), ("test", far)):
            out = mo.predictions(found[name].model, side, labels)
            parts.append(out.select(F.lit(name).alias("model"), F.lit(s).alias("split"), "y", "pred"))
    parts += _knn(marked, key, y, features, folds, found)
    predictions = keep(reduce(DataFrame.unionByName, parts))
    scores = ev.class_scores(ev.confusion_cells(predictions, "y", "pred", ["model", "split"]), ["model", "split"])
    metrics = ev.metrics_of(scores, ["model", "split"])
    best = mo.best_parameters(spark, found)
    cv = [s.folds(spark, name) for name, s in found.items() if s is not None and s.rows]
    return {
        "predictions": predictions, "metrics": metrics, "best_params": best,
        "cv_scores": mo.score_table(reduce(DataFrame.unionByName, cv)),
        "reports": ev.classification_report(scores, ["model", "split"]),
        "test_comparison": ev.with_best_params(ev.comparison_order(metrics), best),
    }


def forest_candidate(trees: int) -> mo.Candidate:
    """The forest with the limits it is grown with."""
    params = {"n_estimators": trees, "max_depth": mo.MAX_DEPTH, "min_samples_leaf": mo.LEAF_ROWS}
    return mo.Candidate(params, lambda n: mo.random_forest(trees))


def _knn(marked, key, y, features, folds, found) -> list[DataFrame]:
    """Neighbour votes for held-out folds, train rows and test rows.

    The nearest rows in every fold are looked for once; leaving a fold out then leaves out what it brought.
    """
    import json

    points = keep(marked.select(key, F.col(y).cast("string").alias("y"), "split", "fold", F.array(*features).alias("x")))
    train = points.filter("split = 'train'")
    near = _near_by_fold(points, key, folds)

    def predicted(rows: DataFrame, pairs: DataFrame) -> DataFrame:
        pred = neighbours.predicted_labels(neighbours.nearest_of_parts(pairs, key), key, "y")
        return pred.join(rows.select(key, "y"), key)

    rows = []
    for fold in range(folds):
        left = near.filter((F.col("part") != fold) & F.col("part").isNotNull() & (F.col("split") == "train"))
        scores = {}
        for side, own in (("train", F.col("fold") != fold), ("test", F.col("fold") == fold)):
            cells = ev.confusion_cells(predicted(train.filter(own), left.filter(own)), "y", "pred").collect()
            scores[side] = mo.macro_f1((r["y"], r["pred"], r["n"]) for r in cells)
        params = json.dumps({"n_neighbors": neighbours.NEIGHBOURS, "weights": "distance"})
        rows.append({"at": 0, "params": params, "fold": fold, **scores})
    candidate = mo.Candidate({"n_neighbors": neighbours.NEIGHBOURS, "weights": "distance"}, lambda n: None)
    mean = sum(r["test"] for r in rows) / len(rows)
    found[KNN] = mo.Search(rows=rows, best=candidate, best_score=mean)
    out = []
    for s in ("train", "test"):
        own = F.col("split") == s
        out.append(predicted(points.filter(own), near.filter(own)).select(F.lit(KNN).alias("model"), F.lit(s).alias("split"), "y", "pred"))
    return out


def _near_by_fold(points: DataFrame, key: str, folds: int) -> DataFrame:
    """(key, split, fold, part, neighbour, y, distance): the nearest training rows of every fold for each row; ``part`` is the
    fold of the neighbours, null for training rows without one. A key that stands in several splits or folds stays apart."""
    own = F.concat_ws(":", "split", F.coalesce("fold", F.lit(-2)), F.col(key).cast("string"))
    asked = keep(points.withColumn("_id", own))
    train = points.filter("split = 'train'")
    parts = [(fold, train.filter(F.col("fold") == fold)) for fold in range(folds)]
    loose = train.filter(F.col("fold").isNull())
    if loose.limit(1).count():
        parts.append((None, loose))
    tables = []
    for fold, base in parts:
        pairs = neighbours.nearest_by_cells(asked.select("_id", "x"), base.select(F.col(key).alias("_id"), "x", "y"), "_id", "x", "y")
        tables.append(cut_lineage(pairs.select("_id", "neighbour", "y", "distance", F.lit(fold).cast("int").alias("part"))))
    ids = asked.select("_id", key, "split", "fold").distinct()
    out = cut_lineage(reduce(DataFrame.unionByName, tables).join(ids, "_id"))
    asked.unpersist()
    return out
