"""The forest against Spark's own, and its independence of blocks."""

import os
import random
import uuid

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ledgerlens.plans import forest as G
from ledgerlens.plans import modeling as ML
from ledgerlens.session import materialize, scratch_dir


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    data = []
    for i in range(1500):
        a, b, c = rng.randrange(20) / 20, rng.randrange(9), rng.randrange(31)
        data.append((i, float(rng.random() < 0.15 + 0.5 * (a > 0.4) * (b > 3) + 0.01 * c), [a, float(b), float(c)]))
    v = spark.createDataFrame(data, "row long, label double, x array<double>")
    return materialize(v.select("row", "label", array_to_vector("x").alias("features"), F.when(F.col("label") == 1, 1.7).otherwise(0.6).alias("w")))


def scores(model, rows):
    return np.array([r.p for r in model.transform(rows).orderBy("row").select(vector_to_array("probability")[1].alias("p")).collect()])


def test_the_same_tree_as_sparks_forest(rows):
    for depth, least in ((1, 2), (3, 40), (6, 25)):
        est = RandomForestClassifier(numTrees=1, maxDepth=depth, featureSubsetStrategy="all", bootstrap=False, minInstancesPerNode=least, seed=3, weightCol="w")
        want, got = est.fit(rows), G.fit_forest(est, rows, [0.6, 1.7])
        assert got.totalNumNodes == want.totalNumNodes
        assert scores(got, rows) == pytest.approx(scores(want, rows), abs=1e-9)
        assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-9)
        if depth == 6:
            assert got.totalNumNodes > 9                                   # leaves of one prediction are merged in both


def test_a_forest_does_not_depend_on_blocks(rows, monkeypatch):
    est = RandomForestClassifier(numTrees=12, maxDepth=6, minInstancesPerNode=2, seed=3)
    one = G.fit_forest(est, rows, [0.6, 1.7]).forest
    monkeypatch.setattr(G, "BLOCK_BYTES", 1200)
    monkeypatch.setattr(G, "UNIT_TREES", 2)
    four = G.fit_forest(est, rows.repartition(3), [0.6, 1.7]).forest
    for name in ("feature", "last", "left", "rows"):
        assert np.array_equal(getattr(one, name), getattr(four, name))
    assert len({tuple(one.feature[a:b]) for a, b in zip(one.start, one.start[1:])}) > 6     # trees differ


def test_poisson_counts_and_drawn_features():
    times = G._times_drawn(np.arange(200_000, dtype=np.int64), 42, 5)
    assert times.mean() == pytest.approx(1.0, abs=0.02) and times.var() == pytest.approx(1.0, abs=0.03)
    assert (times == 0).mean() == pytest.approx(np.exp(-1), abs=0.01)
    drawn = G._features_drawn(np.arange(1, 20_001), 75, 9, 42, 5)
    assert drawn.shape == (20_000, 9) and np.all(np.diff(drawn, axis=1) > 0)
    assert np.bincount(drawn.ravel(), minlength=75) / 20_000 == pytest.approx(np.full(75, 9 / 75), abs=0.012)


def test_fit_rf_grows_no_forest_of_sparks_and_persists(spark, monkeypatch):
    df = spark.range(900).selectExpr("cast(id as string) id", "1 rn", "cast((id * 7) % 10 > 4 as int) target", "(id * 7) % 10 + id % 3 x",
                                     "if(id % 5 = 0, null, id % 11) y")
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda *a: pytest.fail("Spark's own forest"))
    model = ML.fit_rf(df, n_trees=7, max_depth=4)
    assert isinstance(model.stages[-1], RandomForestClassificationModel) and model.stages[-1].getNumTrees == 7
    assert ML.model_inputs(model) == ["x", "y", "y_isnan"]
    path = os.path.join(scratch_dir(spark, "tests"), f"forest-{uuid.uuid4().hex[:8]}")
    model.write().save(path)
    again = PipelineModel.load(path)
    score = lambda m: [r.pred_proba for r in ML.predict_batch(m, df).orderBy(F.col("id").cast("int")).collect()]
    assert score(again) == pytest.approx(score(model), abs=1e-9)
    assert again.stages[-1].featureImportances.toArray() == pytest.approx(model.stages[-1].featureImportances.toArray(), abs=1e-9)
    assert len(model.stages[-1].trees) == 7 and again.stages[-1].getMaxDepth() == 4


def test_ablation_prepares_once_and_has_the_forests_of_separate_fits(spark, monkeypatch):
    rng = random.Random(4)
    data = [(str(i), 1, int(rng.random() < 0.2 + 0.6 * (i % 7 > 3)), float(i % 7), rng.random(), None if i % 5 == 0 else rng.random()) for i in range(900)]
    df = materialize(spark.createDataFrame(data, "id string, rn int, target int, a double, b double, c double"))
    groups = {"first": ["a"], "holes": ["c"], "none": []}
    apart = ML.group_ablation(df, groups, fit=lambda tr, fs: ML.fit_rf(tr, fs, n_trees=100, max_depth=10, seed=42)).collect()
    calls, real = [], ML.median_values
    monkeypatch.setattr(ML, "median_values", lambda *a: (calls.append(1), real(*a))[1])
    once = ML.group_ablation(df, groups).collect()
    assert len(calls) == 1 and [r.group for r in once] == [r.group for r in apart]
    for a, b in zip(once, apart):
        assert (a.n_cols, a.roc_auc, a.delta_auc) == pytest.approx((b.n_cols, b.roc_auc, b.delta_auc), abs=1e-9)
    assert once[1].delta_auc < -0.1


def test_permuted_forest_scores_are_those_of_whole_rows(spark, monkeypatch):
    rng = random.Random(5)
    data = [(str(i), 1, int(rng.random() < 0.2 + 0.6 * (i % 7 > 3)), float(i % 7), rng.random(), None if i % 5 == 0 else float(i % 3)) for i in range(700)]
    df = materialize(spark.createDataFrame(data, "id string, rn int, target int, a double, b double, c double"))
    model = ML.fit_rf(df, n_trees=9, max_depth=6)
    with monkeypatch.context() as m:
        m.setattr(ML, "ForestModel", type(None))                  # every row scored whole
        whole = ML.permutation_importance(model, df, n_repeats=2).collect()
    from ledgerlens.plans import permuted as P
    monkeypatch.setattr(ML, "_permuted", lambda *a: pytest.fail("every row scored whole"))
    for rows, chunk in ((2_000_000, 1 << 15), (150, 64)):          # one range of scores, five ranges
        monkeypatch.setattr(P, "RANGE_ROWS", rows)
        monkeypatch.setattr(P, "CHUNK_ROWS", chunk)
        got = ML.permutation_importance(model, df, n_repeats=2).collect()
        assert [r.feature for r in got] == [r.feature for r in whole] and got[0].feature == "a"
        for x, y in zip(got, whole):
            assert tuple(x)[1:] == pytest.approx(tuple(y)[1:], abs=1e-9)
