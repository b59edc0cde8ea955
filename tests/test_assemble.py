"""Latest record, tie-breaks, label joins, set operations."""

from pyspark.sql import functions as F

from ledgerlens.operators import assemble as A


def test_latest_record_ties_null_wins(spark):
    rows = [("a", 1, 5, 1, "x"), ("a", 2, 3, 1, "y"), ("a", 2, None, 1, "z"), ("a", 2, 7, 2, "w"),
            ("b", None, 1, 1, "n"), ("b", 1, 1, 1, "m"), ("c", None, 1, 1, "only-null")]
    df = spark.createDataFrame(rows, "id string, rn int, pre_since_opened int, pre_since_confirmed int, v string")
    got = {r["id"]: r["v"] for r in A.latest_record(df).collect()}
    assert got == {"a": "z", "b": "m"}


def test_latest_record_secondary_order(spark):
    rows = [("a", 2, 3, 1, "p"), ("a", 2, 3, 4, "q"), ("a", 2, 3, None, "r"), ("a", 2, 2, 9, "s")]
    df = spark.createDataFrame(rows, "id string, rn int, pre_since_opened int, pre_since_confirmed int, v string")
    assert A.latest_record(df).first()["v"] == "r"


def test_latest_record_invariant_under_repartition(spark):
    rows = [(str(i % 7), i % 5, i % 3, i) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, rn int, pre_since_opened int, k int")
    a = sorted(map(tuple, A.latest_record(df, tiebreak=["k"]).collect()))
    b = sorted(map(tuple, A.latest_record(df.repartition(13), tiebreak=["k"]).collect()))
    assert a == b


def test_join_labels_left_keeps_unlabelled(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2)], "id string, rn int")
    lab = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0)], "id string, flag int")
    got = {r["id"]: r["target"] for r in A.join_labels_left(df, lab).collect()}
    assert got == {"a": 1, "b": 0, "c": None}


def test_union_shards_fills_missing(spark):
    a = spark.createDataFrame([("a", 1, 5)], "id string, rn int, x int")
    b = spark.createDataFrame([(2, "b")], "rn int, id string")
    out = A.union_shards([a, b])
    assert out.columns[0] == "id"
    assert sorted(map(tuple, out.collect())) == [("a", 1, 5), ("b", 2, None)]


def test_dataset_diff(spark):
    a = spark.createDataFrame([("a", 1, 1, 9), ("b", 1, 2, 9), ("c", 1, None, 9)], "id string, rn int, x int, gone int")
    b = spark.createDataFrame([("a", 1, 1, 0), ("b", 1, 3, 0), ("c", 1, None, 0), ("d", 1, 4, 0)],
                              "id string, rn int, x int, new int")
    got = {(r["section"], r["name"]): r["value"] for r in A.dataset_diff(a, b).collect()}
    assert got[("column_removed", "gone")] is None and ("column_added", "new") in got
    assert got[("rows", "added")] == 1 and got[("rows", "removed")] == 0 and got[("rows", "common")] == 3
    assert got[("changed", "x")] == 1


def test_filter_equals_latest(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3), ("b", None)], "id string, rn int")
    assert A.filter_equals_latest(df).count() == 2


def test_numbered_history_matches_window_on_skewed_group(spark):
    """A group holding most rows is split over partitions; numbers and lags stay exact."""
    import random
    from pyspark.sql import Window
    from ledgerlens.operators.sequencing import numbered_history
    rng = random.Random(5)
    rows = [(0 if rng.random() < 0.6 else rng.randint(1, 30), rng.randint(0, 400), k,
             None if rng.random() < 0.1 else rng.randint(0, 9)) for k in range(1500)]
    df = spark.createDataFrame(rows, "g long, d int, k long, v int").repartition(7).filter(F.col("k") >= 0)
    got = numbered_history(df, "g", ["d", "k"], "v", 5, n_parts=16)
    w = Window.partitionBy("g").orderBy("d", "k")
    exp = df.select("*", F.row_number().over(w).alias("seq"), *[F.lag("v", i).over(w).alias(f"lag_{i}")
                                                                 for i in range(1, 6)])
    a = sorted(map(tuple, got.select(*exp.columns).collect()))
    b = sorted(map(tuple, exp.collect()))
    assert a == b


def test_numbered_history_without_hot_groups(spark):
    from pyspark.sql import Window
    from ledgerlens.operators.sequencing import numbered_history
    rows = [(k % 40, (k * 7) % 13, k, k % 5) for k in range(800)]
    df = spark.createDataFrame(rows, "g long, d int, k long, v int")
    got = numbered_history(df, "g", ["d", "k"], "v", 3, n_parts=4)
    w = Window.partitionBy("g").orderBy("d", "k")
    exp = df.select("*", F.row_number().over(w).alias("seq"), *[F.lag("v", i).over(w).alias(f"lag_{i}")
                                                                 for i in range(1, 4)])
    assert sorted(map(tuple, got.select(*exp.columns).collect())) == sorted(map(tuple, exp.collect()))


def test_latest_record_moves_numbered_rows_once(spark, sf, monkeypatch):
    from ledgerlens import session
    from ledgerlens.sources.fixtures import credit_products
    seen, write = [], session.materialize
    monkeypatch.setattr(session, "materialize", lambda df: (seen.append(df), write(df))[1])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")              # a fair share no customer exceeds
        products = credit_products(spark, sf)
        got = A.latest_record(products, tiebreak=["o_orderkey"])
        plan = seen[0]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(id#") == 1 and "SortMergeJoin" in plan and "LeftSemi" not in plan
        assert got.columns == products.columns and got.count() == products.select("id").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    hot = spark.createDataFrame([("a", i, i % 7) for i in range(90)] + [(str(i), 1, 2) for i in range(10)] + [(None, 3, 1)] * 2,
                                "id string, rn int, k int")
    even = spark.createDataFrame([(str(i % 40), i // 40, i) for i in range(160)] + [(None, 1, 500), (None, 1, 501), ("x", None, 1)], "id string, rn int, k int")
    assert not A._even(hot, ["id"]) and A._even(even, ["id"])
    assert sorted((r.id or "", r.rn, r.k) for r in A.latest_record(hot, tiebreak=["k"]).collect()) == sorted(
        [("a", 89, 5), ("", 3, 1)] + [(str(i), 1, 2) for i in range(10)])
    assert sorted((r.id or "", r.rn, r.k) for r in A.latest_record(even, tiebreak=["k"]).collect()) == sorted(
        [("", 1, 501)] + [(str(i), 3, 120 + i) for i in range(40)])
