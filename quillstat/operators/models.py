"""Classifiers, their tuning and what they export.

Models are ``pyspark.ml`` estimators. The reference's penalty weight C multiplies the
sum of losses; the estimators here minimise the mean loss, so regParam is 1/(C n).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    LinearSVC, LogisticRegression, LogisticRegressionModel, OneVsRest, RandomForestClassifier,
)
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstat.functions.scalars import NEAR_ZERO
from quillstat.operators.margins import Margins, fit_margins
from quillstat.operators.paths import PathSolver, Point
from quillstat.operators.sampling import class_weights, with_class_weight
from quillstat.operators.summaries import majority_class
from quillstat.session import side_by_side

# Fixed values.
C_GRID = tuple(float(c) for c in np.logspace(-3, 2, 10))
L1_RATIOS = (0.1, 0.3, 0.5, 0.7, 0.9)
WIDE_C_GRID = tuple(float(c) for c in np.logspace(-2, 1, 5))
WIDE_L1_RATIOS = (0.25, 0.5, 0.75)
RIDGE_C = 0.1
WEAK_L2_C = 1e6
FOLDS = 5
WIDE_FOLDS = 3
TREES = 100
MAX_DEPTH = 12  # a tree level is a pass over the rows; deeper ones only memorise single rows
LEAF_ROWS = 2
FOURIER_FEATURES = 512
SEED = 42


# --- data for the estimators ---------------------------------------------------------

@dataclass(frozen=True)
class Labels:
    """Class names in alphabetical order; the index is the estimator's label."""

    names: tuple[str, ...]

    def index(self, y: Column) -> Column:
        cells = [F.lit(x) for i, c in enumerate(self.names) for x in (c, float(i))]
        return F.try_element_at(F.create_map(*cells), y.cast("string"))

    def name(self, index: Column) -> Column:
        return F.array(*[F.lit(c) for c in self.names])[index.cast("int")]


def fit_labels(df: DataFrame, y: str) -> Labels:
    from quillstat.operators.sampling import class_sizes

    return Labels(tuple(sorted(str(c) for c in class_sizes(df, y) if c is not None)))


def model_table(
    df: DataFrame, y: str, features: Sequence[str] | str, labels: Labels, keep: Sequence[str] = ()
) -> DataFrame:
    """(keep, y, label, features) with features from columns or from one array column."""
    if isinstance(features, str):
        out = df.withColumn("features", array_to_vector(F.col(features)))
    else:
        out = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return out.select(*keep, F.col(y).cast("string").alias("y"), labels.index(F.col(y)).alias("label"), "features")


def standardised(table: DataFrame, train: DataFrame) -> DataFrame:
    """Put a vector column on train mean 0 and population deviation 1.

    For tables too wide for one column per feature. The fitted scaler divides by the
    sample deviation, so its output is stretched by sqrt(n / (n - 1)).
    """
    n = train.count()
    fitted = StandardScaler(inputCol="features", outputCol="_z", withMean=True, withStd=True).fit(train)
    stretch = ElementwiseProduct(
        inputCol="_z", outputCol="_s", scalingVec=Vectors.dense([float(np.sqrt(n / max(n - 1, 1)))] * fitted.mean.size))
    return stretch.transform(fitted.transform(table)).drop("features", "_z").withColumnRenamed("_s", "features")


def with_balance(table: DataFrame, weights: dict) -> DataFrame:
    return with_class_weight(table, "y", weights)


def balance(train: DataFrame) -> dict:
    return class_weights(train, "y")


# --- estimators ----------------------------------------------------------------------

def logistic(
    n: int, c: float | None = 1.0, l1_ratio: float = 0.0, weighted: bool = False, max_iter: int = 5000, tol: float = 1e-8
) -> LogisticRegression:
    """Multinomial logistic regression; ``c=None`` leaves out the penalty."""
    model = LogisticRegression(
        family="multinomial", regParam=0.0 if c is None else 1.0 / (c * n), elasticNetParam=l1_ratio,
        standardization=False, maxIter=max_iter, tol=tol,
    )
    return model.setWeightCol("weight") if weighted else model


class MarginsTogether(OneVsRest):
    """``OneVsRest`` whose linear margins are fitted together: a step of all classes is one pass over the rows."""

    def _fit(self, dataset: DataFrame) -> Margins:
        weight = F.col(self.getWeightCol()) if self.isDefined(self.weightCol) else F.lit(1.0)
        return fit_margins(dataset.select(F.col(self.getLabelCol()).alias("label"), weight.alias("weight"),
                                          F.col(self.getFeaturesCol()).alias("features")), self.getClassifier())


def linear_svm(n: int, c: float = 1.0, max_iter: int = 100, tol: float = 1e-3) -> OneVsRest:
    """One linear margin per class on balanced weights."""
    margin = LinearSVC(
        regParam=1.0 / (c * n), standardization=False, maxIter=max_iter, tol=tol, weightCol="weight")
    return MarginsTogether(classifier=margin, weightCol="weight")


def random_forest(
    trees: int = TREES, depth: int = MAX_DEPTH, weighted: bool = True, leaf_rows: int = LEAF_ROWS
) -> RandomForestClassifier:
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf_rows, featureSubsetStrategy="sqrt", seed=SEED, maxMemoryInMB=256)
    return forest.setWeightCol("weight") if weighted else forest


def fit_baseline(train: DataFrame, n: int, max_iter: int = 5000) -> tuple[LogisticRegressionModel, str]:
    """Unpenalised fit, or one with a negligible penalty if that breaks down."""
    try:
        model = logistic(n, None, max_iter=max_iter).fit(train)
        if np.isfinite(model.coefficientMatrix.toArray()).all():
            return model, "multinomial_no_penalty"
    except Exception as err:  # the solver reports a breakdown as a generic job error
        if "FloatingPoint" not in str(err) and "NaN" not in str(err):
            raise
    return logistic(n, WEAK_L2_C, max_iter=max_iter).fit(train), "multinomial_weak_l2"


def fourier_scale(table: DataFrame) -> float:
    """Kernel width 1 / (p * variance of all entries)."""
    values = table.select(F.explode(vector_to_array("features")).alias("x"))
    v = values.agg(F.var_pop("x")).first()[0]
    p = table.select(F.size(vector_to_array("features")).alias("p")).first()["p"]
    return 1.0 / (p * v) if v else 1.0


def with_fourier(table: DataFrame, gamma: float, dims: int = FOURIER_FEATURES, seed: int = SEED) -> DataFrame:
    """Replace ``features`` by random cosine features whose products approach the
    Gaussian kernel exp(-gamma |a - b|^2), so a linear margin acts as a kernel one."""
    p = table.select(F.size(vector_to_array("features")).alias("p")).first()["p"]
    rng = np.random.default_rng(seed)
    waves = rng.normal(scale=np.sqrt(2.0 * gamma), size=(p, dims))
    shifts = rng.uniform(0.0, 2.0 * np.pi, dims)

    @F.pandas_udf("array<double>")
    def cosines(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=object)
        out = np.sqrt(2.0 / dims) * np.cos(np.stack(x.to_numpy()) @ waves + shifts)
        return pd.Series(list(out))

    return table.withColumn("features", array_to_vector(cosines(vector_to_array("features"))))


def selected_columns(names: Sequence[str], selected: Sequence[str]) -> VectorSlicer:
    """Stage that keeps the selected features, in the order of the full list."""
    chosen = set(selected)
    keep = [i for i, f in enumerate(names) if f in chosen] or list(range(len(names)))
    return VectorSlicer(inputCol="features", outputCol="selected", indices=keep)


def fit_post_selection(
    train: DataFrame, names: Sequence[str], selected: Sequence[str], n: int, weighted: bool = False, c: float = 1.0
) -> PipelineModel:
    """Logistic model on the selected features alone; on all of them if none is."""
    head = logistic(n, c, weighted=weighted).setFeaturesCol("selected")
    return Pipeline(stages=[selected_columns(names, selected), head]).fit(train)


def predict_majority(df: DataFrame, train: DataFrame, y: str) -> DataFrame:
    """Every row gets the most frequent class of the training rows."""
    best = majority_class(train, y).first()["majority_class"]
    return df.withColumn("prediction", F.lit(best))


# --- predictions and coefficients ----------------------------------------------------

def predictions(model: Model, table: DataFrame, labels: Labels, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, y, pred, correct) and, where the model gives them, class probabilities."""
    out = model.transform(table)
    columns = [*keep, "y", labels.name(F.col("prediction")).alias("pred")]
    if "probability" in out.columns:
        p = vector_to_array("probability")
        columns += [F.array_max(p).alias("confidence")]
        columns += [p[i].alias(f"prob_{c}") for i, c in enumerate(labels.names)]
    out = out.select(*columns)
    return out.withColumn("correct", F.col("y") == F.col("pred"))


def coefficients(model: LogisticRegressionModel, spark, name: str, features: Sequence[str], labels: Labels) -> DataFrame:
    """Long (model, class, feature, coefficient) rows of a fitted logistic model."""
    matrix = model.coefficientMatrix.toArray()
    k, p = matrix.shape
    table = pd.DataFrame({
        "model": name, "class": np.repeat(labels.names, p), "feature": np.tile(list(features), k),
        "coefficient": matrix.ravel(),
    })
    out = spark.createDataFrame(table, "model string, class string, feature string, coefficient double")
    return out.withColumns({
        "abs_coefficient": F.abs("coefficient"), "is_nonzero": F.abs("coefficient") > NEAR_ZERO})


# --- tuning --------------------------------------------------------------------------

def macro_f1(cells: Iterable[tuple]) -> float:
    """Macro F1 from (truth, prediction, count) cells, over classes seen in either."""
    truth: dict = {}
    guess: dict = {}
    hits: dict = {}
    for y, p, n in cells:
        truth[y] = truth.get(y, 0) + n
        guess[p] = guess.get(p, 0) + n
        if y == p:
            hits[y] = hits.get(y, 0) + n
    seen = set(truth) | set(guess)
    if not seen:
        return 0.0
    return sum(2 * hits.get(c, 0) / (truth.get(c, 0) + guess.get(c, 0)) for c in seen) / len(seen)


@dataclass
class Candidate:
    """One grid point: its parameters and an estimator for a training size."""

    params: dict
    build: Callable[[int], Estimator]
    in_fold: Callable[[int, int], Estimator] | None = None  # (training size, fold), where folds differ


@dataclass
class Search:
    """Scores of every grid point and fold, and the best grid point refitted."""

    rows: list[dict] = field(default_factory=list)
    best: Candidate | None = None
    best_score: float = float("nan")
    model: Model | None = None

    def active_in_fold(self, fold: int) -> list[int]:
        """Positions of the features that the best grid point of ``penalty_search`` uses when ``fold`` is left out."""
        params = json.dumps(self.best.params)
        return next(r["used"] for r in self.rows if (r["params"], r["fold"]) == (params, fold))

    def folds(self, spark, model: str) -> DataFrame:
        """(model, params, fold, train_score, test_score)."""
        table = [(model, r["params"], r["fold"], r["train"], r["test"]) for r in self.rows]
        return spark.createDataFrame(
            table, "model string, params string, fold int, train_score double, test_score double")

    def path_rows(self, spark, model: str) -> DataFrame:
        """(model, C, l1_ratio, fold, train_score, test_score, active, passes, kkt_gap, converged) of ``penalty_search``:
        one row per grid point and fold; ``l1_ratio`` is null for a LASSO, ``active`` counts coefficients that are not zero."""
        table = [(model, r["C"], r["l1_ratio"], r["fold"], r["train"], r["test"], r["active"], r["passes"], r["gap"], r["converged"])
                 for r in self.rows]
        return spark.createDataFrame(
            table, "model string, C double, l1_ratio double, fold int, train_score double, test_score double, active int, "
                   "passes int, kkt_gap double, converged boolean")


def search(
    table: DataFrame, candidates: Sequence[Candidate], folds: int, parallelism: int = 4, refit: bool = True
) -> Search:
    """Cross-validated macro F1 over a ``fold`` column, then a refit of the best point.

    ``table`` should be cached by the caller: every fit filters it by fold. Fits run
    side by side in threads that share the session, and one aggregation per fit
    counts both the training and the held-out predictions.
    """
    sizes = {r["fold"]: r["count"] for r in table.groupBy("fold").count().collect()}
    total = sum(sizes.values())

    def run(task: tuple[int, int]) -> dict:
        at, fold = task
        candidate = candidates[at]
        n = total - sizes.get(fold, 0)
        estimator = candidate.build(n) if candidate.in_fold is None else candidate.in_fold(n, fold)
        model = estimator.fit(table.filter(F.col("fold") != fold))
        held = F.col("fold") == fold
        cells = model.transform(table).groupBy(held.alias("held"), "label", "prediction").count().collect()
        score = lambda side: macro_f1((r[1], r[2], r[3]) for r in cells if r[0] == side)
        return {"at": at, "params": json.dumps(candidate.params), "fold": fold, "train": score(False), "test": score(True)}

    tasks = [(at, fold) for at in range(len(candidates)) for fold in range(folds)]
    rows = side_by_side(table.sparkSession, run, tasks, parallelism)
    out = Search(rows=rows)
    means = [float(np.mean([r["test"] for r in rows if r["at"] == at])) for at in range(len(candidates))]
    first = int(np.argmax(means))
    out.best, out.best_score = candidates[first], means[first]
    if refit:
        out.model = out.best.build(total).fit(table)
    return out


def penalty_search(
    table: DataFrame, candidates: Sequence[Candidate], folds: int, classes: int, weighted: bool = False, refit: bool = True,
    allowed: Mapping[int, Sequence[int]] | None = None, refit_table: DataFrame | None = None,
) -> Search:
    """``search`` for grids of penalties (``lasso_grid``, ``elastic_net_grid``): all grid points and folds are fitted
    together by ``paths.PathSolver``, a pass over the rows per step, and one more pass counts all predictions.

    ``allowed`` names the features (positions in ``table``) that screening inside each fold has kept. The best point
    is refitted on ``refit_table`` (default ``table``), which may hold other features.
    """
    points = [Point(c.params["C"], 1.0 if c.params["l1_ratio"] is None else c.params["l1_ratio"], fold)
              for c in candidates for fold in range(folds)]
    solver = PathSolver(table, classes, points, weighted, allowed=allowed)
    fits = solver.solve()
    counts = solver.confusion(fits)
    solver.close()
    cells = lambda m: [(t, p, int(n)) for (t, p), n in np.ndenumerate(m) if n]
    out = Search()
    for i, point in enumerate(points):
        params = candidates[i // folds].params
        out.rows.append({
            "at": i // folds, "params": json.dumps(params), **params, "fold": point.fold, "train": macro_f1(cells(counts[i, 0])),
            "test": macro_f1(cells(counts[i, 1])), "active": int((fits.coefficients[i] != 0).sum()),
            "used": np.flatnonzero((np.abs(fits.coefficients[i]) > NEAR_ZERO).any(axis=0)).tolist(),
            "passes": int(fits.passes[i]), "gap": float(fits.gaps[i]), "converged": bool(fits.converged[i])})
    means = [float(np.mean([r["test"] for r in out.rows if r["at"] == at])) for at in range(len(candidates))]
    first = int(np.argmax(means))
    out.best, out.best_score = candidates[first], means[first]
    if refit:
        final = table if refit_table is None else refit_table
        out.model = out.best.build(final.filter("label IS NOT NULL").count()).fit(final)
    return out


def score_table(folds: DataFrame) -> DataFrame:
    """Mean, population std and rank per grid point, with its penalty ``C`` and ``l1_ratio`` (null where a
    candidate has none)."""
    from quillstat.functions.ranking import competition_rank

    per = folds.groupBy("model", "params").agg(
        F.avg("test_score").alias("mean_test_score"), F.stddev_pop("test_score").alias("std_test_score"),
        F.avg("train_score").alias("mean_train_score"), F.stddev_pop("train_score").alias("std_train_score"),
    )
    per = per.withColumns({
        name: F.get_json_object("params", f"$.{name}").cast("double") for name in ("C", "l1_ratio")})
    return per.withColumn("rank_test_score", competition_rank(F.col("mean_test_score"), [F.col("model")]))


def lasso_grid(c_grid: Sequence[float] = C_GRID, weighted: bool = False, max_iter: int = 5000, tol: float = 1e-6) -> list[Candidate]:
    return [
        Candidate({"C": c, "l1_ratio": None}, lambda n, c=c: logistic(n, c, 1.0, weighted, max_iter, tol)) for c in c_grid]


def elastic_net_grid(
    c_grid: Sequence[float] = C_GRID, ratios: Sequence[float] = L1_RATIOS, weighted: bool = False, max_iter: int = 5000,
    tol: float = 1e-6,
) -> list[Candidate]:
    return [
        Candidate({"C": c, "l1_ratio": r}, lambda n, c=c, r=r: logistic(n, c, r, weighted, max_iter, tol))
        for c in c_grid for r in ratios
    ]


def cross_validate(table: DataFrame, build: Callable[[int], Estimator], labels: Labels, folds: int) -> DataFrame:
    """Held-out metrics of a fixed model per fold, (fold, accuracy, ...)."""
    from functools import reduce

    from quillstat.operators.evaluation import confusion_cells, class_scores, metrics_of

    sizes = {r["fold"]: r["count"] for r in table.groupBy("fold").count().collect()}
    parts = []
    for fold in range(folds):
        train, held = table.filter(F.col("fold") != fold), table.filter(F.col("fold") == fold)
        model = build(sum(sizes.values()) - sizes.get(fold, 0)).fit(train)
        parts.append(confusion_cells(predictions(model, held, labels), "y", "pred").withColumn("fold", F.lit(fold + 1)))
    cells = reduce(DataFrame.unionByName, parts)
    return metrics_of(class_scores(cells, ["fold"], labels.names), ["fold"])


def fold_summary(scores: DataFrame, metric: str = "macro_f1") -> DataFrame:
    """Mean and sample standard deviation over folds."""
    return scores.agg(F.avg(metric).alias(f"cv_{metric}_mean"), F.stddev_samp(metric).alias(f"cv_{metric}_std"))


def best_parameters(spark, found: dict[str, Search | None]) -> DataFrame:
    """(model, best_cv_macro_f1, best_params as JSON)."""
    rows = [
        (name, None if s is None else s.best_score, "{}" if s is None else json.dumps(s.best.params))
        for name, s in found.items()
    ]
    return spark.createDataFrame(rows, "model string, best_cv_macro_f1 double, best_params string")
