"""Incremental assembly in keyed buckets, and stored shard profiles."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profile as P
from ledgerlens.operators import profile_store as PS
from ledgerlens.plans import datasets as D
from ledgerlens.session import scratch_dir
from ledgerlens.streaming import assembly as A


def tmp(spark, name):
    return os.path.join(scratch_dir(spark, "tests"), f"{name}-{uuid.uuid4().hex[:8]}")


PRODUCT = "id string, rn int, amount long, enc_paym_0 int, enc_paym_1 int"


def files(spark, out):
    return {p.split("/data/")[1] for p in spark.read.parquet(os.path.join(out, "data")).inputFiles()}


def as_rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_batches_equal_the_whole_and_touch_only_their_buckets(spark):
    labels = spark.createDataFrame([("a", 1), ("b", 0), ("z", 1)], "id string, flag int")
    one = [("a", 1, 5, 0, None), ("b", 2, 6, 1, 0), ("c", 1, 7, None, None), ("b", 1, 1, 0, 0), (None, 1, 1, 0, 0), ("d", None, 1, 0, 0)]
    two = [("a", 2, 2 ** 40, 3, 0), ("e", 1, 9, 0, 0)]
    out = tmp(spark, "assembled")
    df = lambda rows: spark.createDataFrame(rows, PRODUCT)
    first = A.fold_batch(df(one), 0, out, labels, buckets=8)
    assert (first.written, first.matched, first.batches) == (3, 2, 1)
    assert dict(A.read_assembled(spark, out).dtypes)["amount"] == "int"
    before = files(spark, out)
    second = A.fold_batch(df(two), 1, out, labels, buckets=8)
    assert (second.written, second.matched, second.batches) == (4, 2, 2)
    whole = D.dataset_v1(df([r for r in one + two if r[0]]), labels)
    got = A.read_assembled(spark, out)
    assert got.columns == whole.columns and got.dtypes == whole.dtypes      # amount is bigint now
    assert as_rows(got) == as_rows(whole)
    touched = {r[0] for r in df(two).select(A._bucket(8)).collect()}
    kept = {k for k, b in second.buckets.items() if b["version"] == 0}
    assert kept == set(first.buckets) - touched
    assert before >= {f for f in files(spark, out) if f.startswith("v=000000000")} != set()
    # rows that are known, or older than what is known, change nothing
    third = A.fold_batch(df([("a", 1, 5, 0, None), two[0], ("b", 2, 6, 1, 0)]), 2, out, labels, buckets=8)
    assert third.buckets == second.buckets and third.batches == 2
    # a batch that is committed already changes nothing, whatever it holds
    assert A.fold_batch(df([("q", 1, 1, 0, 0)]), 2, out, labels, buckets=8) == third
    assert as_rows(A.read_assembled(spark, out)) == as_rows(whole)
    assert A.fold_batch(df([]), 3, out, labels, buckets=8).buckets == second.buckets
    assert [r.batches for r in A.counters(spark, out).orderBy("batch").collect()] == [2, 2]      # two commits are kept


def test_failed_batch_leaves_the_commit_and_is_run_again(spark, monkeypatch):
    labels = spark.createDataFrame([("a", 1)], "id string, flag int")
    out = tmp(spark, "assembled")
    df = lambda rows: spark.createDataFrame(rows, PRODUCT)
    A.fold_batch(df([("a", 1, 5, 0, 0), ("b", 1, 5, 0, 0)]), 0, out, labels, buckets=4)
    seen = as_rows(A.read_assembled(spark, out))

    def dies(*a):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(A, "_write_commit", dies)
        with pytest.raises(RuntimeError):
            A.fold_batch(df([("a", 2, 6, 2, 0)]), 1, out, labels, buckets=4)
    assert as_rows(A.read_assembled(spark, out)) == seen
    again = A.fold_batch(df([("a", 2, 6, 2, 0)]), 1, out, labels, buckets=4)
    assert again.batches == 2 and as_rows(A.read_assembled(spark, out)) != seen
    # a column that is new
    wide = spark.createDataFrame([("c", 1, 1, 0, 0, 2.5)], PRODUCT + ", extra double")
    A.fold_batch(wide, 2, out, labels, buckets=4)
    got = {r.id: r.extra for r in A.read_assembled(spark, out).collect()}
    assert got == {"a": None, "b": None, "c": 2.5}


def test_stream_resumes(spark, tmp_path):
    labels = spark.createDataFrame([("5", 1), ("6", 0)], "id string, flag int")
    shards, out, ckpt = tmp(spark, "shards"), tmp(spark, "assembled"), tmp(spark, "ckpt")
    rows = spark.range(40).selectExpr("cast(id % 10 as string) AS id", "cast(id AS int) AS rn", "id AS amount",
                                      "0 AS enc_paym_0", "cast(null as int) AS enc_paym_1")
    how = dict(buckets=4, files_per_trigger=2)
    rows.where("rn < 20").coalesce(1).write.parquet(shards)
    schema = spark.read.parquet(shards).schema
    assert A.assemble_stream(spark, shards, out, ckpt, schema, labels, **how).batches == 1
    rows.where("rn >= 20").coalesce(1).write.mode("append").parquet(shards)
    done = A.assemble_stream(spark, shards, out, ckpt, schema, labels, **how)
    assert (done.written, done.matched, done.batches) == (10, 2, 2)
    assert A.assemble_stream(spark, shards, out, ckpt, schema, labels, **how) == done
    assert as_rows(A.read_assembled(spark, out)) == as_rows(D.dataset_v1(rows, labels))


def test_profiles_roll_up_without_old_shards(spark, monkeypatch):
    root, store = tmp(spark, "shards"), tmp(spark, "profiles")
    df = spark.range(6000).selectExpr(
        "cast(id % 3 as int) AS part", "id", "cast(id % 700 as int) AS k", "if(id % 5 = 0, null, id / 7) AS x", "if(id % 2 = 0, double('nan'), 1.5) AS y",
        "concat('t+ ', id % 90) AS t", "id % 2 = 0 AS b", "date_add(date'2020-01-01', cast(id % 30 as int)) AS d",
        "timestamp_seconds(id) AS ts", "cast(id as decimal(12,2)) AS m")
    df.where("part < 2").repartition("part").write.partitionBy("part").parquet(root)
    assert PS.add_profiles(spark, root, store) == 2
    df.where("part = 2").coalesce(1).drop("x").write.mode("append").partitionBy("part").parquet(root)
    read = []
    real = PS.column_profiles
    monkeypatch.setattr(PS, "column_profiles", lambda d, by: (read.append(d.inputFiles()), real(d, by))[1])
    assert PS.add_profiles(spark, root, store) == 1 and len(read[0]) == 1      # old shards stay unread
    assert PS.add_profiles(spark, root, store) == 0
    now = spark.read.option("mergeSchema", "true").parquet(root)
    got = {r["column"]: r for r in PS.roll_up(spark, root, store).collect()}
    full = {r["column"]: r for r in P.prof_basic(now.drop("part")).collect()}
    assert set(got) == set(full)
    for c, r in full.items():
        assert got[c]["n_rows"] == r["n_rows"] and got[c]["null_rate"] == pytest.approx(r["null_rate"])
        assert abs(got[c]["n_unique"] - r["n_unique"]) <= 0.07 * r["n_unique"] + 1
    assert (got["k"]["lo"], got["k"]["hi"], got["t"]["lo_text"], got["t"]["hi_text"]) == (0.0, 699.0, "t+ 0", "t+ 9")
    assert (got["b"]["lo"], got["b"]["hi"], got["ts"]["hi"], got["y"]["hi"]) == (0.0, 1.0, 5999.0, 1.5)
    assert got["d"]["hi"] - got["d"]["lo"] == 29


def test_distinct_counts_keep_types(spark):
    df = spark.createDataFrame([(1, 1.0, "1", None), (1, float("nan"), "1 ", True), (2, 1.0, None, True), (None, 0.1 + 0.2, "", False)],
                               "a int, b double, c string, d boolean")
    got = {r["column"]: r["n_unique"] for r in P.distinct_counts(df, df.columns).collect()}
    assert got == {"a": 3, "b": 3, "c": 4, "d": 3}
    text = P.distinct_counts(df, df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert "as string" not in text
