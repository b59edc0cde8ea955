"""Sparse categories, type widening over shards, run metadata, ablation groups."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import sparse_categories as SP
from ledgerlens.plans import modeling as ML
from ledgerlens.session import scratch_dir
from ledgerlens.sources import widening as W


def tmp(spark, name):
    return os.path.join(scratch_dir(spark, "tests"), f"{name}-{uuid.uuid4().hex[:8]}")


def test_one_hot_of_a_hundred_thousand_categories(spark):
    df = spark.range(100_000).selectExpr("id AS k", "cast(id % 3 as string) AS g")
    cats = SP.fit_categories(df, ["k", "g"])
    assert cats.sizes == {"k": 100_000, "g": 3}
    path = tmp(spark, "cats")
    cats.save(path)
    again = SP.Categories.load(spark, path)
    assert again.sizes == cats.sizes
    new = spark.createDataFrame([(0, "0"), (7, "2"), (99_999, None), (10 ** 7, "9"), (None, "1")], "k long, g string")
    got = {r.k: r.one_hot for r in SP.one_hot_sparse(new, cats).collect()}
    order = {str(v): i for i, v in enumerate(sorted(str(i) for i in range(100_000)))}
    assert all(v.size == 100_003 for v in got.values())
    slots = {k: v.indices.tolist() for k, v in got.items()}
    assert slots == {0: [order["0"], 100_000], 7: [order["7"], 100_002], 99_999: [order["99999"]], 10 ** 7: [], None: [100_001]}


def test_slots_of_sparse_and_dense_vectors(spark):
    from pyspark.ml.linalg import SparseVector, Vectors
    wide = 1 << 30                                                     # written out in full: 8 GB a row
    rows = [(0, SparseVector(wide, [5, wide - 1], [1.0, 1.0])), (1, SparseVector(wide, [3, 4], [0.0, 1.0])),
            (2, SparseVector(3, [], [])), (3, Vectors.dense(0.0, 1.0, 1.0))]
    df = spark.createDataFrame(rows, ["k", "v"])
    assert {r.k: r.s for r in df.select("k", SP.slots("v").alias("s")).collect()} == {0: [5, wide - 1], 1: [4], 2: [], 3: [1, 2]}


def test_wider():
    assert W.wider(["int", "bigint", "int"]) == "bigint" and W.wider(["int", "float"]) == "double"
    assert W.wider(["float"]) == "float" and W.wider(["double", "string"]) == "string" and W.wider(["date", "int"]) == "string"


def test_shards_of_other_types_load(spark):
    root = tmp(spark, "mixed")
    spark.createDataFrame([(1, 1.5, "a")], "x int, y float, only string").coalesce(1).write.parquet(root)
    spark.createDataFrame([(2 ** 40, "t")], "x long, y string").coalesce(1).write.mode("append").parquet(root)
    spark.createDataFrame([(3, None)], "x int, y float").coalesce(1).write.mode("append").parquet(root)
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", "true").parquet(root).collect()
    types = W.shard_types(spark, root)
    df = W.scan_widened(spark, root, types=types)
    assert dict(df.drop("source_file").dtypes) == {"x": "bigint", "y": "string", "only": "string"}
    assert sorted((tuple(r) for r in df.select("x", "y", "only").collect()), key=str) == [
        (1, "1.5", "a"), (1099511627776, "t", None), (3, None, None)]
    gone = W.absent_columns(spark, types, ["y", "only"]).collect()
    assert len(gone) == 2 and {r.column for r in gone} == {"only"}         # y is NULL in one shard, but there


def test_run_metadata_and_groups(spark):
    rows = [(str(i), 1, int(i % 3 == 0), float(i % 3 + (i % 7) / 10), float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "id string, rn int, target int, good double, other double")
    m = ML.fit_logreg(df, max_iter=20)
    path = ML.persist_run(m, tmp(spark, "model"), df, df, "lr", {"C": 1.0}, seed=3)
    meta = ML.read_metadata(spark, path)
    ev = ML.evaluate_model(ML.load_model(path), df).first()
    assert meta["roc_auc"] == pytest.approx(ev.roc_auc) and meta["auc_pr"] == pytest.approx(ev.auc_pr)
    assert (meta["n_train"], meta["n_valid"], meta["seed"], meta["params"], meta["features"]) == (120, 120, 3, {"C": 1.0}, ["good", "other"])
    groups = ML.match_groups(ML.feature_columns(df), {"g": "^go", "none": "^zz"})
    assert groups == {"g": ["good"], "none": []}
    fit = lambda t, f: ML.fit_rf(t, f, n_trees=5, max_depth=3)
    one = [tuple(r) for r in ML.group_ablation(df, groups, fit=fit, workers=1).collect()]
    assert one == [tuple(r) for r in ML.group_ablation(df, groups, fit=fit, workers=3).collect()]
    assert one[2] == ("none", 0, None, None) and one[1][3] < 0
