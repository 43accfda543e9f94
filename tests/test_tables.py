import json
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillstat.functions import scalars, skew
from quillstat.functions.skew import members_of
from quillstat.operators import collinearity, duplicates, evaluation, prep, quality, sampling, structure, summaries
from quillstat.operators.models import logistic
from quillstat.sources import tables


def test_coercion_and_text(spark):
    df = spark.createDataFrame([(" 1.5 ",), ("x",), ("2d",), ("nan",), (None,), ("-3e2",)], "t string")
    got = [r[0] for r in df.select(scalars.to_number(F.col("t"))).collect()]
    assert got == [1.5, None, None, None, None, -300.0]
    text = [r[0] for r in df.select(scalars.clean_text(F.col("t"))).collect()]
    assert text[0] == "1.5" and text[4] is None


def test_scaling_expressions(spark):
    df = spark.createDataFrame([(0.0, 1.0), (5.0, 1.0)], "a double, b double")
    row = df.agg(F.min("a").alias("lo"), F.max("a").alias("hi"), F.min("b").alias("bl"), F.max("b").alias("bh"))
    out = row.select(
        scalars.unit_range(F.lit(2.5), F.col("lo"), F.col("hi")), scalars.unit_range(F.lit(1.0), F.col("bl"), F.col("bh"))).first()
    assert tuple(out) == (0.5, 1.0)
    vif = spark.createDataFrame([(0.9,), (1.0,), (0.5,)], "r2 double").select(scalars.vif_from_r2(F.col("r2")).alias("v"))
    flags = vif.select("v", scalars.vif_flag(F.col("v")), scalars.partial_r2(F.col("v"))).collect()
    assert flags[1][0] == math.inf and flags[1][1] == "strong" and flags[1][2] == 1.0
    assert flags[2][1] == "ok" and flags[2][2] == pytest.approx(0.5)


def test_repeated_keys_with_a_hot_key_and_clashing_hashes(spark, monkeypatch):
    rows = [("hot", i) for i in range(200)] + [("two", 1), ("two", 2), ("one", 1), (None, 1), (None, 2)]
    df = spark.createDataFrame(rows, "word string, n int").repartition(4)
    expected = sorted((str(w), n) for w, n in rows if w != "one")
    found = lambda: sorted((str(r["word"]), r["n"]) for r in members_of(df, ["word"]).collect())
    assert found() == expected
    monkeypatch.setattr(skew, "_hash_key", lambda df, keys: [F.lit(1).alias("_h1"), F.lit(2).alias("_h2")])
    assert found() == expected


def test_duplicates_treat_missing_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 1.0)], "a int, b double")
    assert tuple(duplicates.duplicate_count(df).first()) == (3, 2, 1)
    assert duplicates.without_duplicates(df).count() == 2
    assert duplicates.duplicate_count(df.limit(0)).first()["duplicates_removed"] == 0


def test_schema_checks(spark):
    df = spark.createDataFrame([(1, "a", 1.0, "x")], "id int, y string, f double, g string")
    with pytest.raises(ValueError, match="word"):
        quality.require_columns(df, ["id", "word"])
    assert quality.feature_columns(df, ["id", "y"]) == ["f", "g"]
    with pytest.raises(ValueError, match="g"):
        quality.require_numeric(df, ["f", "g"])
    assert not quality.check_width(["f"]) and quality.check_width(["f"], 1)
    with pytest.raises(ValueError):
        quality.check_width(["f"], 2210, strict=True)
    good = quality.alignment_report(spark, ["f"], ["f"], ["f"])
    assert all(r["passed"] for r in good.collect())
    with pytest.raises(ValueError):
        quality.alignment_report(spark, ["f", "g"], ["g", "f"], ["f", "g"])
    report = {r["check"]: r["passed"] for r in quality.matrix_report(df, df, ["f", "g"], ["id", "y"]).collect()}
    assert report["same_feature_order"] and report["same_as_metadata"] and not report["train_all_numeric"]
    with pytest.raises(ValueError, match="missing"):
        quality.require_features(df, df, ["f", "zz"])


def test_label_checks(spark):
    df = spark.createDataFrame([("a", "train"), ("a", "train"), ("b", "train"), ("a", "test"), (None, "test")], "y string, split string")
    with pytest.raises(ValueError):
        quality.require_valid_labels(df, "y", ["a", "b"])
    with pytest.raises(ValueError):
        quality.require_class_size(df.filter("y = 'b'"), "y")
    with pytest.raises(ValueError, match="test"):
        quality.require_classes(df, "y", "split", ["a", "b"], ["train", "test"])


def test_empty_missing_report_keeps_its_columns(spark):
    df = spark.createDataFrame([("train", 1.0)], "split string, f double")
    out = quality.missing_columns(df, ["f"], "split")
    assert out.columns == ["split", "column", "n_missing", "missing_rate"] and out.count() == 0


def test_standardising_constant_and_missing_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (1.0, 4.0, None)], "c double, v double, none double")
    scaling = prep.fit_scaling(df, ["c", "v"])
    rows = prep.apply_scaling(df, scaling).collect()
    assert [r["c"] for r in rows] == [0.0, 0.0] and sorted(r["v"] for r in rows) == [-1.0, 1.0]
    assert prep.fit_medians(df, ["none"]) == {"none": None}


def test_expansion_forms_agree(spark):
    names = ["a", "b", "c"]
    df = spark.createDataFrame([(2.0, 3.0, 5.0)], "a double, b double, c double")
    wide = prep.expand_columns(df, names, [])
    assert wide.columns == prep.expanded_names(names) == ["a", "b", "c", "a_sq", "b_sq", "c_sq", "a_x_b", "a_x_c", "b_x_c"]
    array = df.select(prep.expand_array(F.array(*names)).alias("z")).first()["z"]
    assert list(wide.first()) == array == [2.0, 3.0, 5.0, 4.0, 9.0, 25.0, 6.0, 10.0, 15.0]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 0.5, 1.0, 1.0]], "x double")
    got = {r["bin"]: r["n"] for r in summaries.histogram(df, F.col("x"), 2, 0.0, 1.0).collect()}
    assert got == {0: 1, 1: 3}
    assert summaries.histogram(df.filter("x = 1"), F.col("x"), 4).first()["n"] == 2


def test_sources_and_sinks(spark, tmp_path):
    path = tmp_path / "names.json"
    path.write_text('["b", "a"]')
    assert [(r["position"], r["feature"]) for r in tables.read_name_list(spark, str(path)).collect()] == [(0, "b"), (1, "a")]
    (tmp_path / "bad.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="JSON list"):
        tables.read_name_list(spark, str(tmp_path / "bad.json")).collect()
    matrix = tmp_path / "m.csv"
    matrix.write_text(",f1,f2\nA,0.5,0\nB,-1,2\n")
    assert sorted(map(tuple, tables.read_labelled_matrix(spark, str(matrix)).collect())) == [
        ("A", "f1", 0.5), ("A", "f2", 0.0), ("B", "f1", -1.0), ("B", "f2", 2.0)]
    df = spark.createDataFrame([("train", 1, math.inf), ("test", 2, 1.0)], "split string, id int, v double")
    tables.write_split_tables(df, str(tmp_path / "s"))
    assert tables.read_split(spark, str(tmp_path / "s"), "test").select("id").first()[0] == 2
    tables.write_csv(df, str(tmp_path / "c"))
    assert tables.read_csv(spark, str(tmp_path / "c")).count() == 2
    tables.write_summary(df.filter("id = 1"), str(tmp_path / "j"))
    record = json.loads(spark.read.text(str(tmp_path / "j")).first()[0])
    assert record == {"summary": {"split": "train", "id": 1, "v": None}}
    assert tables.resolve_features(["b", "z"], ["a", "b"]) == ["b"]
    assert tables.resolve_features(["z"], ["a", "b"]) == tables.resolve_features(None, ["a", "b"]) == ["a", "b"]
    with pytest.raises(ValueError):
        tables.resolve_features(["z"], ["a"], strict=True)
    names = spark.createDataFrame([("b", 0), ("z", 1)], "feature string, position int")
    have = spark.createDataFrame([("a",), ("b",)], "feature string")
    assert [r["feature"] for r in tables.keep_existing(names, have).collect()] == ["b"]


def test_models_are_saved_and_missing_ones_skipped(spark, tmp_path):
    from pyspark.ml.linalg import Vectors

    rows = [(float(i % 3), Vectors.dense([float(i % 3), float(i % 5)])) for i in range(30)]
    df = spark.createDataFrame(rows, ["label", "features"])
    tables.save_model(logistic(30, 1.0).fit(df), str(tmp_path / "m"))
    found = tables.load_models({"there": str(tmp_path / "m"), "gone": str(tmp_path / "nothing")})
    assert list(found) == ["there"] and found["there"].transform(df).count() == 30


def test_empty_tables(spark):
    df = spark.createDataFrame([], "split string, y string, f double, g double")
    assert [r["missing_percent"] for r in quality.missing_by_feature(df, ["f", "g"]).collect()] == [None, None]
    assert summaries.class_distribution(df, "y").count() == 0
    assert quality.class_shape_wide(df, "split", "y", ["f"], ["a"]).count() <= 1
    assert duplicates.repeated_keys(df, ["f"], ["y"]).count() == 0
    assert prep.fit_medians(df, ["f"]) == {}


def test_missing_labels_are_one_class(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, "a"), (None, None), ("b", "b")], "y string, pred string")
    rows = {r["label"]: r for r in evaluation.class_scores(evaluation.confusion_cells(df, "y", "pred")).collect()}
    assert set(rows) == {"a", "b", None} and rows[None]["support"] == 2 and rows[None]["f1"] == pytest.approx(0.5)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame([("train", 1.0, 1.0), ("train", float("nan"), 2.0), ("test", None, 3.0)], "split string, x double, z double")
    report = {r["feature"]: r for r in prep.imputation_report(df, "split", {"x": 1.0, "z": 2.0}).collect()}
    assert report["x"]["train_missing_count_before"] == 1 and report["x"]["test_missing_count_before"] == 1
    assert prep.sparse_columns(df, ["x", "z"], 0.5) == ["x"]
    assert prep.drop_sparse_rows(df, ["x", "z"], 0.0).count() == 1


def test_rows_without_a_class_have_no_fold(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else "c") for i in range(30)], "id int, y string")
    folds = [(r["y"], r["fold"]) for r in sampling.with_folds(df, "y", ["id"], 5).collect()]
    assert all(f is None for y, f in folds if y is None) and {f for y, f in folds if y} == set(range(5))


def test_correlations_with_gaps_agree_at_any_width(spark):
    rng = np.random.default_rng(1)
    table = rng.normal(size=(60, 25)) + rng.normal(size=(60, 1))
    table[rng.random(table.shape) < 0.2] = np.nan
    table[:, 24] = 3.0
    names = [f"f{k:02}" for k in range(25)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) and k % 2 else float(v) for k, v in enumerate(r)) for r in table], names).repartition(5)
    want = pd.DataFrame(table, columns=names).corr()
    for width in (8, 9, 25):
        got = collinearity.pair_correlations(df, names[:width], undefined=0.0).collect()
        assert len(got) == width * (width - 1) // 2
        for r in got:
            value = want.loc[r["feature_1"], r["feature_2"]]
            assert r["correlation"] == pytest.approx(0.0 if np.isnan(value) or "f24" in (r["feature_1"], r["feature_2"]) else value, abs=1e-9)


def test_kmeans_does_not_depend_on_partitions(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.normal(size=3).tolist()) for i in range(400)], "id int, x array<double>")
    one, seven = (structure.kmeans_sweep(df.repartition(n), "x", [3], 2)[3] for n in (1, 7))
    assert one.inertia == pytest.approx(seven.inertia) and np.allclose(one.centres, seven.centres)
