import hashlib
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillstat.functions import ordering
from quillstat.functions.ordering import exact_quantiles
from quillstat.operators import sampling


def _long(spark, columns):
    rows = [(f, None if v is None else float(v)) for f, values in columns.items() for v in values]
    return spark.createDataFrame(rows, "feature string, value double").repartition(4)


@pytest.mark.parametrize("order_rows", [1_000_000, 50])
@pytest.mark.parametrize("q", [0.5, 0.25])
def test_quantiles_equal_sorted_values(spark, order_rows, q):
    rng = np.random.default_rng(1)
    columns = {
        "even": [1, 2, 3, 10], "odd": [3, 1, 2], "wide": rng.normal(size=2001), "heavy": np.r_[np.zeros(700), rng.exponential(size=1301)],
        "two": [0] * 1000 + [1] * 1000, "tail": np.r_[rng.normal(size=999), 1e12], "same": [4.0] * 500, "gaps": [None, 5, None, 7],
        "none": [None, None],
    }
    got = exact_quantiles(_long(spark, columns), q, order_rows=order_rows)
    for name, values in columns.items():
        kept = [float(v) for v in values if v is not None]
        if not kept:
            assert got[name] is None
        else:
            assert got[name] == pytest.approx(float(np.quantile(kept, q)), abs=1e-12), name


def _classes(spark, sizes):
    rows = [(f"{c}{i}", c) for c, n in sizes.items() for i in range(n)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "id string, y string").repartition(5)


def test_split_has_exact_quotas_and_ignores_partitioning(spark):
    df = _classes(spark, {"noun": 434, "verb": 62, "adjective": 39})
    out = sampling.with_split(df, "y", ["id"])
    counts = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert [counts[c, "test"] for c in ("noun", "verb", "adjective")] == [87, 12, 8]
    again = sampling.with_split(df.repartition(2).orderBy("id"), "y", ["id"])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, again.collect()))


def test_split_takes_the_smallest_hashes(spark):
    df = _classes(spark, {"a": 50, "b": 7})
    out = {r["id"]: r["split"] for r in sampling.with_split(df, "y", ["id"], 0.2, 42).collect()}
    digest = lambda i: hashlib.md5(f"42|{i}".encode()).hexdigest()
    for c, n in (("a", 11), ("b", 1)):
        ids = sorted((i for i in out if i[0] == c), key=digest)
        assert {i for i in ids if out[i] == "test"} == set(ids[:n])


@pytest.mark.parametrize("sizes", [{"a": 53, "b": 21, "c": 3}, {"a": 10}])
def test_folds_are_balanced_per_class(spark, sizes):
    out = sampling.with_folds(_classes(spark, sizes), "y", ["id"], 5)
    counts = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    for c, n in sizes.items():
        per = [counts.get((c, f), 0) for f in range(5)]
        assert sum(per) == n and max(per) - min(per) <= 1


def test_class_weights_sum_to_rows(spark):
    df = _classes(spark, {"a": 30, "b": 10})
    weighted = sampling.with_class_weight(df, "y", sampling.class_weights(df, "y"))
    sums = {r["y"]: r["s"] for r in weighted.groupBy("y").agg(F.sum("weight").alias("s")).collect()}
    assert sums == pytest.approx({"a": 20.0, "b": 20.0})
    assert pd.Series(sums).sum() == pytest.approx(40.0)


def test_many_cuts_are_searched_by_halving(spark):
    """Each value was compared with two rows of cuts, one by one."""
    import numpy as np

    from quillstat.functions import ordering

    long = spark.range(3000).selectExpr("'f' AS feature", "cast(id % 1500 AS double) AS value")
    sizes = spark.createDataFrame([("f", 3000)], "feature string, n long")
    cuts = ordering.value_cuts(long, "feature", "value", sizes, 10)
    binned = ordering.with_value_bins(long, cuts, "feature", "value")
    row = cuts.first()
    edges = np.concatenate([row["coarse"], *row["fine"]])
    assert all(r["bin"] == (edges <= r["value"]).sum() for r in binned.collect())
    assert "ArrowEvalPython" in binned._jdf.queryExecution().executedPlan().toString()


def test_spread_values_are_settled_without_probes_and_crowded_or_endless_ones_with(spark, monkeypatch):
    probed = []
    real = ordering._probe
    monkeypatch.setattr(ordering, "_probe", lambda rows, spans: probed.extend(r["f"] for r in spans.collect()) or real(rows, spans))
    rng = np.random.default_rng(3)
    columns = {"even": rng.uniform(-5, 5, 3001), "few": np.repeat([1.0, 2.0, 9.0], 1000), "crowded": np.append(rng.uniform(0, 1, 3000), 1e300),
               "endless": np.append(rng.normal(size=3000), [np.inf, -np.inf]), "one": np.full(3000, np.inf)}
    rows = [(f, float(v)) for f, values in columns.items() for v in values]
    got = ordering.exact_quantiles(spark.createDataFrame(rows, "feature string, value double"), 0.5, order_rows=200)
    assert got == {f: float(np.median(values)) for f, values in columns.items()}
    assert set(probed) == {"crowded", "endless"}
