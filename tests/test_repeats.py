import pandas as pd
import pytest

from quillstat.functions import skew


@pytest.mark.parametrize("most", [20, 1])
def test_repeats_per_split_and_in_all(spark, monkeypatch, most):
    monkeypatch.setattr(skew, "MAX_SPLITS", most)
    rows = [("train", 1, "a"), ("train", 1, "a"), ("test", 1, "a"), ("test", None, "b"), ("test", None, "b"), (None, 2, "c"), (None, 1, "a"), ("train", 3, None)]
    df = spark.createDataFrame(rows, "split string, k long, w string")
    got = {r["split"]: r["n"] for r in skew.excess_rows(df, ["k", "w"], "split", "n").filter("split IS NOT NULL").collect()}
    table = pd.DataFrame(rows, columns=["split", "k", "w"])
    want = {s: int(g.duplicated(["k", "w"]).sum()) for s, g in table.groupby("split")}
    assert got == want | {"total": int(table.duplicated(["k", "w"]).sum())}
    empty = skew.excess_rows(df.limit(0), ["k"], "split", "n").collect()
    assert [tuple(r) for r in empty] == [("total", 0)]


def test_repeats_shuffle_rows_once(spark):
    df = spark.range(100).selectExpr("if(id % 5 = 0, 'test', 'train') AS split", "id % 60 AS k")
    plan = skew.excess_rows(df, ["k"], "split", "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
