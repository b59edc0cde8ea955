"""Stored histories, callbacks per shard, and the fingerprinted diff."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import aligned as AL
from ledgerlens.operators import assemble as A
from ledgerlens.session import scratch_dir
from ledgerlens.streaming.shards import ShardTooLarge, map_shards


def tmp(spark, name):
    return os.path.join(scratch_dir(spark, "tests"), f"{name}-{uuid.uuid4().hex[:8]}")


def test_stored_history_joins_without_moving(spark):
    name = f"history_{uuid.uuid4().hex[:8]}"
    rows = [(str(i), 1 + i % 3, i % 4, i % 10, "x") for i in range(500)]
    whole = spark.createDataFrame(rows, "id string, rn int, enc_paym_0 int, enc_paym_1 int, note string")
    AL.store_history(whole, name, tmp(spark, "history"))
    products = whole.drop("enc_paym_1").withColumn("enc_paym_0", F.lit(99))
    got = AL.join_history(products, name)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1                       # the products', none on the history's side
    assert plan.index("Exchange") < plan.index("Bucketed: true") and "SortMergeJoin" in plan
    assert sorted(map(tuple, got.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    extra = products.unionByName(spark.createDataFrame([("new", 1, 0, "x")], "id string, rn int, enc_paym_0 int, note string"))
    r = {x.id: x for x in AL.join_history(extra, name).collect()}
    assert r["new"].enc_paym_0 is None and len(r) == 501
    spark.sql(f"DROP TABLE {name}")


def test_alignment_report(spark):
    name = f"history_{uuid.uuid4().hex[:8]}"
    h = spark.createDataFrame([("a", 1, 0), ("a", 1, 5), ("b", 1, 1), ("z", 9, 1)], "id string, rn int, enc_paym_0 int")
    p = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2)], "id string, rn int")
    AL.store_history(h, name, tmp(spark, "history"))
    assert tuple(AL.alignment_report(p, name).first()) == (3, 4, 1, 1, 1)
    assert sorted(map(tuple, AL.join_history(p, name).select("id", "rn", "enc_paym_0").collect()), key=str) == [
        ("a", 1, 5), ("b", 1, 1), ("b", 2, None)]
    spark.sql(f"DROP TABLE {name}")


def test_callback_sees_whole_shards(spark):
    root = tmp(spark, "shards")
    df = spark.range(30_000).selectExpr("cast(id % 3 as int) AS part", "id", "cast(pmod(hash(id), 1000) as int) AS v")
    df.repartition(3, "part").write.option("parquet.block.size", 1 << 14).partitionBy("part").parquet(root)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    seen = lambda pdf: pdf.assign(rows=len(pdf), rank=pdf.v.rank(method="first").astype("int64"))[["id", "rows", "rank"]]
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")        # other scans are cut
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "777")
        out = map_shards(spark, root, seen, "id long, rows long, rank long", ["id", "v"])
        assert spark.read.parquet(root).rdd.getNumPartitions() > out.rdd.getNumPartitions()
        got = out.toPandas()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old[1])
    assert len(got) == 30_000 and set(got.rows) == {10_000}
    for p in range(3):
        assert sorted(got[got.id % 3 == p]["rank"]) == list(range(1, 10_001))
    part = map_shards(spark, root, lambda pdf: pdf[["id"]].head(1), "id long", limit_files=2).collect()
    assert len(part) == 2 and {r.id % 3 for r in part} == {0, 1}
    with pytest.raises(ShardTooLarge, match="part=0.*parquet"):
        map_shards(spark, root, seen, "id long, rows long, rank long", max_bytes=100)


def test_diff_joins_only_differing_buckets(spark, monkeypatch):
    rows = [(str(i // 2 if i % 10 == 0 else i), i % 4, i % 7, None if i % 5 == 0 else float(i)) for i in range(3000)] + [(None, None, 1, 1.0)]
    a = spark.createDataFrame(rows, "id string, rn int, x int, y double").repartition(5)
    moved = []
    real = A._numbered
    monkeypatch.setattr(A, "_numbered", lambda df, *how: (moved.append(df.count()), real(df, *how))[1])
    same = {(r["section"], r["name"]): r["value"] for r in A.dataset_diff(a, a.repartition(3)).collect()}
    assert not moved and same["rows", "common"] == 3001 and same["changed", "x"] == 0
    changed = [(i, n, x + 1 if (i, n) == ("77", 1) else x, y) for i, n, x, y in rows if i != "5"] + [("new", 1, 1, 1.0)]
    b = spark.createDataFrame(changed, a.schema)
    got = {(r["section"], r["name"]): r["value"] for r in A.dataset_diff(a, b).collect()}
    n5, n77 = sum(r[0] == "5" for r in rows), sum(r[:2] == ("77", 1) for r in rows)
    assert (got["rows", "removed"], got["rows", "added"], got["rows", "common"]) == (n5, 1, 3001 - n5)
    assert (got["changed", "x"], got["changed", "y"]) == (n77, 0)
    assert sum(moved) < 60                                   # of 6,001 rows
    one = {(r["section"], r["name"]): r["value"] for r in A.dataset_diff(a, b, buckets=1).collect()}
    assert one == got
