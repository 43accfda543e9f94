"""Clustering and distance operators against brute force in NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstat.operators import linkage, neighbours, structure


def _points(spark, x, labels=None):
    labels = labels if labels is not None else ["a"] * len(x)
    rows = [(i, [float(v) for v in p], str(c)) for i, (p, c) in enumerate(zip(x, labels))]
    return spark.createDataFrame(rows, "id long, x array<double>, c string").repartition(3)


def _pairs(spark, d):
    n = len(d)
    return spark.createDataFrame(
        [(i, j, float(d[i, j])) for i in range(n) for j in range(i + 1, n)], "i int, j int, d double")


def _slow_linkage(d):
    groups = {i: [i] for i in range(len(d))}
    merges = []
    while len(groups) > 1:
        keys = sorted(groups)
        best = min((max(d[p, q] for p in groups[a] for q in groups[b]), a, b) for a in keys for b in keys if a < b)
        h, a, b = best
        groups[a] = groups[a] + groups.pop(b)
        merges.append((a, b, h, len(groups[a])))
    return merges


def test_complete_linkage_equals_one_merge_at_a_time(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(25, 2))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    merges = linkage.complete_linkage(_pairs(spark, d), 25)
    got = [(r["a"], r["b"], r["size"]) for r in merges.orderBy("step").collect()]
    slow = _slow_linkage(d)
    assert got == [(a, b, s) for a, b, _, s in slow]
    assert [r["height"] for r in merges.orderBy("step").collect()] == pytest.approx([h for _, _, h, _ in slow])
    labels = {r["node"]: r["cluster_id"] for r in linkage.cut_tree(merges, 25, clusters=4).collect()}
    assert len(set(labels.values())) == 4
    height = slow[10][2]
    labels = {r["node"]: r["cluster_id"] for r in linkage.cut_tree(merges, 25, height=height).collect()}
    assert len(set(labels.values())) == 25 - 11


def test_complete_linkage_with_ties(spark):
    d = np.ones((4, 4)) - np.eye(4)
    merges = linkage.complete_linkage(_pairs(spark, d), 4).collect()
    assert len(merges) == 3 and {r["height"] for r in merges} == {1.0}


def test_feature_clusters(spark):
    pairs = spark.createDataFrame(
        [("a", "b", 0.95), ("a", "c", 0.85), ("b", "c", 0.7), ("a", "d", 0.1), ("b", "d", 0.1), ("c", "d", 0.2)],
        "feature_1 string, feature_2 string, abs_correlation double")
    got = {r["feature"]: r["cluster_size"] for r in linkage.feature_clusters(pairs, ["a", "b", "c", "d"]).collect()}
    assert got == {"a": 2, "b": 2, "c": 1, "d": 1}  # c is near a but not near b


def _slow_silhouette(x, c):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        own = (c == c[i]) & (np.arange(len(x)) != i)
        if not own.any():
            out.append(0.0)
            continue
        a = d[i, own].mean()
        b = min(d[i, c == o].mean() for o in set(c) - {c[i]})
        out.append((b - a) / max(a, b))
    return out


@pytest.mark.parametrize("block_rows", [1000, 9])
def test_silhouette_equals_brute_force(spark, block_rows):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(40, 3))
    c = np.array(["p"] * 20 + ["q"] * 19 + ["alone"])
    got = neighbours.silhouette_rows(_points(spark, x, c), "id", "x", "c", block_rows).orderBy("id").collect()
    assert [r["silhouette"] for r in got] == pytest.approx(_slow_silhouette(x, c))


@pytest.mark.parametrize("block_rows", [1000, 6])
def test_neighbours_equal_brute_force(spark, block_rows):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(30, 2))
    x[25] = x[3]  # a query that coincides with a base row
    c = np.where(np.arange(30) % 3 == 0, "u", "v")
    df = _points(spark, x, c)
    base, queries = df.filter("id < 22"), df.filter("id >= 22")
    found = neighbours.nearest_neighbours(queries, base, "id", "x", "c", 5, block_rows).orderBy("id", "rank").collect()
    d = np.sqrt(((x[22:, None] - x[None, :22]) ** 2).sum(-1))
    expected = [(22 + i, int(j)) for i in range(8) for j in np.argsort(d[i], kind="stable")[:5]]
    assert [(r["id"], r["neighbour"]) for r in found] == expected
    pred = {r["id"]: (r["pred"], r["confidence"]) for r in neighbours.knn_predict(queries, base, "id", "x", "c", 5, block_rows).collect()}
    assert pred[25] == ("u", 1.0)  # the exact match wins alone
    few = neighbours.nearest_neighbours(queries, base.filter("id < 3"), "id", "x", "c", 5, block_rows)
    assert few.count() == 24


def test_copies_are_ordered_by_key_and_measured_by_differences(spark):
    rng = np.random.default_rng(6)
    x = np.repeat(rng.normal(size=(6, 8)) + 1e4, 7, axis=0)
    i, j, d = neighbours._nearest(x[:12], x, 5, 4)
    assert j.reshape(12, 5).tolist() == [list(range(5))] * 7 + [list(range(7, 12))] * 5 and (d == 0).all()


def test_small_blocks_do_not_copy_a_row_for_every_block(spark):
    """The grid once copied each row for each block: 100 times here."""
    df = spark.range(800)
    assert neighbours._strips(df, 8) <= 10 and neighbours._strips(df, 1000) == 1


def test_components_equal_eigenvectors(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(80, 3)) @ np.diag([3.0, 2.0, 1.0]) + 5.0
    parts = structure.fit_pca(_points(spark, x), "x", ["a", "b", "c"])
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert parts.ratios == pytest.approx((values / values.sum())[::-1])
    assert np.abs(parts.loadings) == pytest.approx(np.abs(vectors[:, ::-1]), abs=1e-8)
    assert all(col[np.abs(col).argmax()] > 0 for col in parts.loadings.T)
    scored = structure.with_scores(_points(spark, x), "x", parts, 2)
    sums = scored.select(F.avg(F.col("scores")[0]), F.avg(F.col("scores")[1])).first()
    assert tuple(sums) == pytest.approx((0.0, 0.0), abs=1e-9)
    table = structure.variance_table(spark, parts)
    assert structure.components_for(table, 0.75).first()[0] == int(np.argmax(np.cumsum(parts.ratios) >= 0.75)) + 1


def test_components_of_standardised_features_are_not_turned_by_rounding(spark):
    rng = np.random.default_rng(19)
    x = rng.normal(size=(4000, 2))
    x[:, 1] -= x[:, 0] * (x[:, 0] @ x[:, 1]) / (x[:, 0] @ x[:, 0])  # nearly uncorrelated
    x = (x - x.mean(0)) / x.std(0) + 1e-9 * x[:, ::-1] * [1.0, 1.5]
    parts = structure.fit_pca(_points(spark, x), "x", ["a", "b"], standardised=True)
    assert np.abs(parts.loadings) == pytest.approx(np.full((2, 2), np.sqrt(0.5)), abs=1e-15)
    assert (parts.mean == 0).all() and parts.ratios.sum() == pytest.approx(1.0)


def test_kmeans_sweep_finds_separate_groups(spark):
    rng = np.random.default_rng(8)
    centres = np.array([[0, 0], [20, 0], [0, 20], [20, 20]])
    x = np.concatenate([c + rng.normal(size=(15, 2)) for c in centres])
    df = _points(spark, x)
    fits = structure.kmeans_sweep(df, "x", [2, 4], 8)
    within = sum(((x[i * 15 : i * 15 + 15] - x[i * 15 : i * 15 + 15].mean(0)) ** 2).sum() for i in range(4))
    assert fits[4].inertia == pytest.approx(within) and fits[2].inertia > within
    labels = df.withColumn("k", structure.nearest_centre(F.col("x"), fits[4].centres))
    truth = labels.withColumn("t", (F.col("id") / 15).cast("int"))
    assert tuple(structure.agreement(truth, "k", "t").first()) == pytest.approx((1.0, 1.0))


def test_row_clusters_cover_every_row(spark):
    rng = np.random.default_rng(12)
    df = _points(spark, np.concatenate([rng.normal(size=(30, 2)), rng.normal(size=(30, 2)) + 30]))
    exact = structure.exact_row_clusters(df, "id", "x", [2])
    coarse = structure.centroid_row_clusters(df, "id", "x", [2], 10)
    for out in (exact, coarse):
        sizes = sorted(r["count"] for r in out.groupBy("k2").count().collect())
        assert sizes == [30, 30]


def test_agreement_of_unrelated_single_label(spark):
    df = spark.createDataFrame([("a", "x")] * 5, "p string, q string")
    assert tuple(structure.agreement(df, "p", "q").first()) == (1.0, 1.0)


def test_cells_give_the_same_neighbours_with_fewer_pairs(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(15, 3)) * 20
    x = np.vstack([centres[rng.integers(0, 15, 1500)] + rng.normal(size=(1500, 3)), np.tile(centres[:1], (700, 1))])  # a third alike
    df = spark.createDataFrame([(i, [float(a) for a in v], f"c{i % 3}") for i, v in enumerate(x)], "id long, x array<double>, tag string").cache()
    asked, base = df.filter("id % 10 = 0"), df.filter("id % 10 != 0")
    report = {}
    found = neighbours.nearest_by_cells(asked, base, "id", "x", "tag", 4, 150, report=report).collect()
    points, names = x[np.arange(len(x)) % 10 != 0], np.flatnonzero(np.arange(len(x)) % 10 != 0)
    got = {}
    for r in sorted(found, key=lambda r: (r.id, r.rank)):
        assert r.tag == f"c{r.neighbour % 3}"
        got.setdefault(r.id, []).append(r.neighbour)
    for i, mine in got.items():
        d = np.sqrt(((points - x[i]) ** 2).sum(axis=1))
        assert mine == names[np.lexsort((names, d))[:4]].tolist()
    assert len(got) == 220 and report["pairs"] < report["all_pairs"] / 4
    assert neighbours.nearest_by_cells(asked, base.limit(0), "id", "x", "tag").count() == 0
    assert neighbours.nearest_by_cells(asked.limit(0), base, "id", "x", "tag").count() == 0
    assert neighbours.nearest_by_cells(asked, base.limit(2), "id", "x", "tag").count() == 440


def test_votes_of_folds_come_from_one_search_a_fold(spark, monkeypatch):
    from functools import reduce

    from pyspark.sql import functions as F

    from quillstat.operators import evaluation as ev
    from quillstat.plans import alternatives

    rng = np.random.default_rng(5)
    rows = [(i // 2 if i < 6 else i, None if i % 17 == 3 else "abc"[i % 3], "test" if i % 5 == 0 else "train",
             -1 if i % 5 == 0 else (None if i % 17 == 3 else i % 2), *rng.integers(0, 6, 2).astype(float).tolist()) for i in range(60)]
    marked = spark.createDataFrame(rows, "id int, y string, split string, fold int, a double, b double").repartition(2)
    search, met = neighbours.nearest_by_cells, []

    def counted(queries, base, *args, **kw):
        met.append(base.count())
        return search(queries, base, *args, **kw)

    monkeypatch.setattr(neighbours, "nearest_by_cells", counted)
    found = {}
    parts = alternatives._knn(marked, "id", "y", ["a", "b"], 2, found)
    got = sorted(map(str, reduce(lambda a, b: a.unionByName(b), parts).collect()))
    assert sum(met) == sum(r[2] == "train" for r in rows)  # a training row is searched once
    points = marked.withColumn("x", F.array("a", "b"))
    train = points.filter("split = 'train'")
    want = [str(r) for s in ("train", "test") for side in [points.filter(F.col("split") == s)]
            for r in neighbours.knn_predict(side, train, "id", "x", "y").join(side.select("id", "y"), "id").select(
                F.lit("k-NN").alias("model"), F.lit(s).alias("split"), "y", "pred").collect()]
    assert got == sorted(want)
    held = train.filter("fold = 1")
    pred = neighbours.knn_predict(held, train.filter("fold <> 1"), "id", "x", "y").join(held.select("id", "y"), "id")
    from quillstat.operators.models import macro_f1
    assert found[alternatives.KNN].rows[1]["test"] == macro_f1((r["y"], r["pred"], r["n"]) for r in ev.confusion_cells(pred, "y", "pred").collect())
