"""Sources/sinks, the incremental stream and the Spark ML path on the smallest tables."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.assemble import latest_record
from ledgerlens.plans import catalog as C
from ledgerlens.plans import modeling as ML
from ledgerlens.session import scratch_dir
from ledgerlens.sources import io as IO
from ledgerlens.sources.fixtures import credit_products, labels_credit
from ledgerlens.streaming.incremental import complete_versions, incremental_assembly, row_fn


def _tmp(spark, name):
    return os.path.join(scratch_dir(spark, "tests"), f"{name}-{uuid.uuid4().hex[:8]}")


def test_csv_labels_roundtrip(spark, sf):
    path = _tmp(spark, "labels") + ".csv"
    IO.sink_csv(labels_credit(spark, sf), path)
    got = IO.scan_csv_labels(spark, path)
    assert got.columns == ["id", "target"] and dict(got.dtypes)["target"] == "tinyint"
    assert got.count() == labels_credit(spark, sf).count()
    with pytest.raises(ValueError):
        IO.scan_by_suffix(spark, path + ".json")


def test_shards_profile_and_inventory(spark, sf):
    root = C.write_shards(spark, sf)
    df = IO.scan_shards(spark, root)
    prof = {(r["shard"], r["column"]): r["null_rate"]
            for r in IO.shard_profile(df, ["pre_loans_next_pay_summ"], "shard").collect()}
    assert all(v == 1.0 for (s, c), v in prof.items() if s >= 6)
    inv = IO.shard_inventory(spark, root).first()
    assert inv["n_files"] >= 12 and inv["total_bytes"] >= inv["max_bytes"] > 0


def test_incremental_assembly_equals_batch(spark, sf):
    root = C.write_shards(spark, sf, drop_upper=False)
    schema = spark.read.parquet(root).schema
    out, ckpt = _tmp(spark, "versions"), _tmp(spark, "ckpt")
    last = incremental_assembly(spark, root, out, ckpt, schema, tiebreak=["o_orderkey"], files_per_trigger=5)
    # nothing new: the newest version is still the answer, and old ones are gone
    assert incremental_assembly(spark, root, out, ckpt, schema, tiebreak=["o_orderkey"]) == last
    assert len(complete_versions(spark, out)) <= 2
    got = sorted(map(tuple, spark.read.parquet(last).select("id", "rn", "o_orderkey").collect()))
    exp = sorted(map(tuple, latest_record(credit_products(spark, sf), tiebreak=["o_orderkey"])
                     .select("id", "rn", "o_orderkey").collect()))
    assert got == exp


def test_row_fn(spark, sf):
    out = row_fn(credit_products(spark, sf).select("id", "rn", "pre_loans_outstanding", "pre_loans_credit_limit"),
                 C._util_pd, "id string, rn int, util_pd double")
    assert out.columns == ["id", "rn", "util_pd"] and out.count() > 0


def test_logreg_fit_predict_persist(spark, sf):
    tr, va = C._train_valid(spark, sf)
    m = ML.fit_logreg(tr, max_iter=50)
    ev = ML.evaluate_model(m, va).first()
    assert 0.0 <= ev["roc_auc"] <= 1.0 and ev["n_samples"] == va.count()
    path = ML.model_persist(m, _tmp(spark, "model"), {"model": "logreg"})
    assert ML.read_metadata(spark, path)["model"] == "logreg"
    pred = ML.predict_batch(ML.load_model(path), va.drop("target"))
    assert pred.columns == ["id", "rn", "pred_proba"]
    assert pred.filter((F.col("pred_proba") < 0) | (F.col("pred_proba") > 1)).count() == 0


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "target" in df.columns
    assert set(E.oracle_sql()) <= set(E.queries())


def test_scan_limit_files_and_resolve(spark, sf):
    root = C.write_shards(spark, sf)
    files = IO.list_shards(spark, root)
    assert len(files) >= 12 and files == sorted(files)
    part = IO.scan_shards(spark, root, limit_files=3)
    assert part.select("source_file").distinct().count() == 3
    assert IO.resolve_columns(["id", "rn", "enc_paym_1", "enc_paym_0", "x"], ["rn", "zz"], ["enc_paym_"]) == \
        ["enc_paym_0", "enc_paym_1", "rn"]


def test_stratified_folds_and_permutation_do_not_depend_on_partitions(spark):
    from ledgerlens.plans import modeling as ML
    rows = [(str(i), 1, int(i % 5 == 0), float(i)) for i in range(503)]
    df = spark.createDataFrame(rows, "id string, rn int, target int, x double")
    # rows left after a split that was cut on the plain seed
    train = ML.split_frame(df, 0.2, 42).filter("not is_valid").drop("is_valid")
    seen = []
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            folds = ML.stratified_folds(train, 4, 42).collect()
            for c in (0, 1):
                sizes = [sum(r["target"] == c and r["fold"] == f for r in folds) for f in range(4)]
                assert max(sizes) - min(sizes) <= 1
            moved = ML.permute_column(df, "x", 7, ["id", "rn"]).collect()
            assert sorted(r["x"] for r in moved) == sorted(x[3] for x in rows)
            assert sum(r["x"] == float(r["id"]) for r in moved) < 15
            seen.append((sorted((r["id"], r["fold"]) for r in folds), sorted((r["id"], r["x"]) for r in moved)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert seen[0] == seen[1]


def test_planted_feature_ranks_first_and_missing_flags_enter(spark):
    from ledgerlens.plans import modeling as ML
    import random
    rng = random.Random(0)
    rows = [(str(i), 1, i % 2, i % 2 + rng.random() * 0.2, None if i % 7 == 0 else rng.random(), rng.random()) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, rn int, target int, good double, holes double, noise double")
    sp = ML.split_frame(df, 0.3, 42)
    m = ML.fit_rf(sp.filter("not is_valid").drop("is_valid"), n_trees=10, max_depth=4)
    assert "holes_isnan" in ML.model_inputs(m) and "good_isnan" not in ML.model_inputs(m)
    imp = ML.permutation_importance(m, sp.filter("is_valid").drop("is_valid"), n_repeats=2).collect()
    assert imp[0]["feature"] == "good" and {r["feature"] for r in imp} == {"good", "holes", "noise"}
    abl = {r["group"]: r for r in ML.group_ablation(
        df, {"none": [], "noise": ["noise"]}, fit=lambda t, f: ML.fit_rf(t, f, n_trees=5, max_depth=3)).collect()}
    assert abl["none"]["n_cols"] == 0 and abl["none"]["roc_auc"] is None and abl["noise"]["n_cols"] == 1


def test_registered_boosting_is_the_whole_search(spark, sf, monkeypatch):
    """30 draws, 4 folds, a round limit far above where early stopping ends."""
    from ledgerlens.plans import catalog as C
    asked = {}
    monkeypatch.setattr(C, "_train_valid", lambda spark, sf: (None, None))
    monkeypatch.setattr(C, "finish", lambda df: df)
    monkeypatch.setattr(C, "v3_split", lambda spark, sf: spark.createDataFrame([(True,)], "is_valid boolean"))
    monkeypatch.setattr(C.ML, "feature_columns", lambda df: [])
    monkeypatch.setattr(C.ML, "evaluate_model", lambda *a: None)
    monkeypatch.setattr(C.ML, "fit_gbt", lambda *a, **how: asked.update(gbt=how))
    monkeypatch.setattr(C.ML, "random_search_cv", lambda df, **how: asked.update(search=how))
    C.REGISTRY["fit_gbt"](spark, sf)
    C.REGISTRY["random_search_cv"](spark, sf)
    assert asked["search"] == {"n_iter": 30, "n_folds": 4, "max_iter": 5000}
    assert asked["gbt"]["max_iter"] == 5000 and asked["gbt"]["valid_col"] == "is_valid"


def test_shards_of_one_schema_are_written_in_one_pass(spark, sf, monkeypatch):
    from ledgerlens.plans import catalog as C
    calls, write = [], C.IO.sink_parquet
    monkeypatch.setattr(C.IO, "sink_parquet", lambda df, *a, **k: (calls.append(df), write(df, *a, **k))[1])
    root = C.write_shards(spark, sf, drop_upper=False, one_file=True)
    assert len(calls) == 1
    back = spark.read.parquet(root)
    assert back.count() == C.cp(spark, sf).count() and back.select("shard").distinct().count() == 12
    assert back.select("shard", F.input_file_name()).distinct().count() == 12


def test_forest_keeps_the_node_of_every_row(spark):
    df = spark.range(400).selectExpr("cast(id as string) id", "1 rn", "cast((id * 7) % 10 > 4 as int) target", "(id * 7) % 10 + id % 3 x", "id % 11 y")
    model = ML.fit_rf(df, n_trees=5, max_depth=4)
    assert model.stages[-1].getCacheNodeIds() and ML.evaluate_model(model, df).first()["roc_auc"] > 0.9
