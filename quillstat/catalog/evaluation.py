"""Metric, report, confusion and comparison queries on rule-made predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillstat.catalog.fixtures import CLASSES, KEYS, PREDICTIONS, model_predictions, predictions, rounded
from quillstat.catalog.registry import query
from quillstat.operators import evaluation as ev
from quillstat.sources.tables import read_table

_KEYS = ["model", "split"]
_PROBS = [f"prob_{c}" for c in CLASSES]

SCORES = PREDICTIONS + """,
cells AS (SELECT model, split, y, pred, count(*) AS n FROM pm GROUP BY ALL),
labels0 AS (SELECT DISTINCT model, split, y AS label FROM cells UNION SELECT DISTINCT model, split, pred FROM cells),
sc AS (
  SELECT l.model, l.split, l.label,
         coalesce(sum(n) FILTER (c.y = l.label AND c.pred = l.label), 0) AS hits,
         coalesce(sum(n) FILTER (c.y = l.label), 0) AS support,
         coalesce(sum(n) FILTER (c.pred = l.label), 0) AS predicted
  FROM labels0 l JOIN cells c ON l.model = c.model AND l.split = c.split GROUP BY ALL),
cs AS (SELECT *, CASE WHEN predicted > 0 THEN hits / CAST(predicted AS DOUBLE) ELSE 0 END AS p,
              CASE WHEN support > 0 THEN hits / CAST(support AS DOUBLE) ELSE 0 END AS r,
              CASE WHEN support + predicted > 0 THEN 2.0 * hits / CAST(support + predicted AS DOUBLE) ELSE 0 END AS f FROM sc),
mt AS (
  SELECT model, split, sum(hits) / CAST(sum(support) AS DOUBLE) AS accuracy, avg(r) FILTER (support > 0) AS balanced_accuracy,
         avg(p) AS macro_precision, avg(r) AS macro_recall, avg(f) AS macro_f1,
         sum(p * support) / sum(support) AS weighted_precision, sum(r * support) / sum(support) AS weighted_recall,
         sum(f * support) / sum(support) AS weighted_f1
  FROM cs GROUP BY 1, 2)"""


def _scores(spark, sf):
    return ev.class_scores(ev.confusion_cells(model_predictions(spark, sf), "y", "pred", _KEYS), _KEYS)


def _metrics(spark, sf):
    return ev.metrics_of(_scores(spark, sf), _KEYS)


@query(f"""WITH {SCORES}
SELECT model, split, {", ".join(f"round({m}, 8) AS {m}" for m in ev.METRICS)} FROM mt""")
def model_metrics(spark, sf):
    return rounded(_metrics(spark, sf), 8, *ev.METRICS)


@query(f"""WITH {SCORES}
SELECT model, split, label, round(p, 8) AS precision, round(r, 8) AS recall, round(f, 8) AS f1, CAST(support AS BIGINT) AS support FROM cs""")
def class_metrics(spark, sf):
    return rounded(_scores(spark, sf).drop("hits"), 8, "precision", "recall", "f1")


@query(f"""WITH {SCORES}
SELECT model, split, label, round(p, 8) AS precision, round(r, 8) AS recall, round(f, 8) AS f1,
       CAST(support AS BIGINT) AS support, CAST(NULL AS DOUBLE) AS score FROM cs
UNION ALL SELECT model, split, 'accuracy', NULL, NULL, NULL, CAST(sum(support) AS BIGINT), round(sum(hits) / CAST(sum(support) AS DOUBLE), 8)
FROM cs GROUP BY 1, 2
UNION ALL SELECT model, split, 'macro avg', round(avg(p), 8), round(avg(r), 8), round(avg(f), 8), CAST(sum(support) AS BIGINT), NULL
FROM cs GROUP BY 1, 2
UNION ALL SELECT model, split, 'weighted avg', round(sum(p * support) / sum(support), 8), round(sum(r * support) / sum(support), 8),
       round(sum(f * support) / sum(support), 8), CAST(sum(support) AS BIGINT), NULL FROM cs GROUP BY 1, 2""")
def classification_report(spark, sf):
    return rounded(ev.classification_report(_scores(spark, sf), _KEYS), 8, "precision", "recall", "f1", "score")


_FOUR = [*CLASSES, "X"]
_MATRIX = PREDICTIONS + f""",
g AS (SELECT model, split, c AS true_class FROM (SELECT DISTINCT model, split FROM pm)
      CROSS JOIN (VALUES {", ".join(f"('{c}')" for c in _FOUR)}) v(c)),
cm AS (SELECT g.model, g.split, g.true_class,
       {", ".join(f'''count(*) FILTER (pm.pred = '{c}') AS "{c}"''' for c in _FOUR)}, count(pm.y) AS size
       FROM g LEFT JOIN pm ON g.model = pm.model AND g.split = pm.split AND g.true_class = pm.y GROUP BY ALL)"""


@query(f"""WITH {_MATRIX} SELECT * EXCLUDE (size) FROM cm""")
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(model_predictions(spark, sf), "y", "pred", _FOUR, _KEYS)


@query(f"""WITH {_MATRIX}
SELECT model, split, true_class, {", ".join(f'round("{c}" / CAST(nullif(size, 0) AS DOUBLE), 8) AS "{c}"' for c in _FOUR)} FROM cm""")
def confusion_matrix_shares(spark, sf):
    out = ev.confusion_matrix(model_predictions(spark, sf), "y", "pred", _FOUR, _KEYS, "missing")
    return out.select(*_KEYS, "true_class", *[F.round(c, 8).alias(c) for c in _FOUR])


@query(f"""WITH {_MATRIX}
SELECT model, split, true_class, {", ".join(f'round(coalesce("{c}" / CAST(nullif(size, 0) AS DOUBLE), 0), 8) AS "{c}"' for c in _FOUR)} FROM cm""")
def confusion_matrix_shares_zero(spark, sf):
    out = ev.confusion_matrix(model_predictions(spark, sf), "y", "pred", _FOUR, _KEYS, "zero")
    return out.select(*_KEYS, "true_class", *[F.round(c, 8).alias(c) for c in _FOUR])


@query(f"""WITH {PREDICTIONS}
SELECT split, round(avg(-ln(greatest(CASE y WHEN 'A' THEN "prob_A" WHEN 'N' THEN "prob_N" ELSE "prob_R" END, 2.220446049250313e-16))), 8)
       AS log_loss, count(*) AS n FROM p GROUP BY 1""")
def log_loss(spark, sf):
    probs = {c: F.col(f"prob_{c}") for c in CLASSES}
    out = predictions(spark, sf).groupBy("split").agg(
        ev.log_loss(F.col("y"), probs).alias("log_loss"), F.count(F.lit(1)).alias("n"))
    return rounded(out, 8, "log_loss")


@query(f"""WITH {PREDICTIONS}
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, y, rule_size AS predicted, y = rule_size AS correct,
       round(greatest("prob_A", "prob_N", "prob_R"), 8) AS confidence FROM p""")
def prediction_confidence(spark, sf):
    out = ev.with_confidence(predictions(spark, sf), "y", "rule_size", _PROBS)
    return rounded(out.select(*KEYS, "y", F.col("rule_size").alias("predicted"), "correct", "confidence"), 8, "confidence")


@query(f"""WITH {PREDICTIONS}, c AS (SELECT y = rule_size AS correct, greatest("prob_A", "prob_N", "prob_R") AS x FROM p)
SELECT correct, CAST(least(floor(x * 15), 14) AS INTEGER) AS bin, count(*) AS n FROM c GROUP BY 1, 2""")
def confidence_histogram(spark, sf):
    return ev.confidence_histogram(ev.with_confidence(predictions(spark, sf), "y", "rule_size", _PROBS))


_NAMES = ("accuracy", "balanced_accuracy", "macro_f1", "weighted_f1")


@query(f"""WITH {SCORES}
SELECT model, {", ".join(f"round(max({m}) FILTER (split = '{s}'), 8) AS {s}_{m}" for s in ("train", "test") for m in _NAMES)}
FROM mt GROUP BY 1""")
def metrics_wide(spark, sf):
    return rounded(ev.metrics_wide(_metrics(spark, sf), _NAMES), 8, *[f"{s}_{m}" for s in ("train", "test") for m in _NAMES])


@query(f"""WITH {SCORES},
l AS ({" UNION ALL ".join(f"SELECT model, split, '{m}' AS metric, round({m}, 8) AS value FROM mt" for m in ev.METRICS)}) SELECT * FROM l""")
def metrics_long(spark, sf):
    return rounded(ev.metrics_long(_metrics(spark, sf)), 8, "value")


def _params(spark, sf):
    """Best-parameter rows made from the data: one model has none."""
    cut = read_table(spark, sf, "lineitem", ["l_quantity"]).agg(F.max("l_quantity").alias("q"))
    return cut.select(F.lit("rule_size").alias("model"), F.to_json(F.struct(F.col("q").alias("C"))).alias("best_params"))


@query(f"""WITH {SCORES},
bp AS (SELECT 'rule_size' AS model, '{{"C":' || CAST(max(l_quantity) AS VARCHAR) || '}}' AS best_params FROM lineitem)
SELECT mt.model, split, round(accuracy, 8) AS accuracy, round(macro_f1, 8) AS macro_f1, best_params
FROM mt LEFT JOIN bp ON mt.model = bp.model""")
def metrics_with_params(spark, sf):
    out = ev.with_best_params(_metrics(spark, sf), _params(spark, sf))
    return rounded(out.select("model", "split", "accuracy", "macro_f1", "best_params"), 8, "accuracy", "macro_f1")


@query(f"""WITH {SCORES}
SELECT model, split, round(macro_f1, 8) AS macro_f1 FROM mt WHERE split = 'train'
ORDER BY mt.macro_f1 DESC, balanced_accuracy DESC, accuracy DESC, model LIMIT 1""")
def chosen_model(spark, sf):
    out = ev.choose_model(_metrics(spark, sf), split="train")
    return rounded(out.select("model", "split", "macro_f1"), 8, "macro_f1")


@query(f"""WITH {SCORES}
SELECT model, split, round(macro_f1, 8) AS macro_f1,
       row_number() OVER (ORDER BY mt.macro_f1 DESC, balanced_accuracy DESC, model) AS position FROM mt WHERE split = 'test'""")
def comparison_table(spark, sf):
    out = ev.comparison_order(_metrics(spark, sf))
    return rounded(out.select("model", "split", "macro_f1", "position"), 8, "macro_f1")


@query("""
WITH t AS (SELECT *, CASE WHEN l_linenumber <= 5 THEN 'train' ELSE 'test' END AS split FROM lineitem),
m AS (SELECT l_returnflag AS c FROM t WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT split, (SELECT c FROM m) AS predicted, round(avg(CASE WHEN l_returnflag = (SELECT c FROM m) THEN 1.0 ELSE 0.0 END), 8) AS accuracy
FROM t GROUP BY 1""")
def majority_prediction(spark, sf):
    from quillstat.operators.models import predict_majority

    df = predictions(spark, sf)
    guessed = predict_majority(df, df.filter("split = 'train'"), "y")
    out = guessed.groupBy("split", F.col("prediction").alias("predicted")).agg(
        F.avg((F.col("y") == F.col("prediction")).cast("double")).alias("accuracy"))
    return rounded(out, 8, "accuracy")
