"""Profiling, schema operators and sampling on small frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profile as P
from ledgerlens.operators import sampling as SM
from ledgerlens.operators import schema as SC
from ledgerlens.operators.bands import band_expr


def test_corr_matrix_pairwise_and_constant(spark):
    rows = [(float(i), 2.0 * i + (1 if i % 3 else 0), 1.0, None if i % 4 == 0 else float(-i)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in P.corr_matrix(df).collect()}
    a = np.array([r[0] for r in rows]); b = np.array([r[1] for r in rows])
    assert got[("a", "b")] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-12)
    assert got[("a", "c")] is None
    assert got[("a", "d")] == pytest.approx(-1.0, abs=1e-12)


def test_identical_columns(spark):
    df = spark.createDataFrame([(str(i), 1, i % 3, i % 3, float(i), float(i), i % 3 * 1.0) for i in range(50)],
                               "id string, rn int, x int, y int, f double, g double, h double")
    got = {r["column"]: r["group_first"] for r in P.identical_columns(df).collect()}
    assert got == {"x": "x", "y": "x", "f": "f", "g": "f"}


def test_prof_basic_and_categorical(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("a", float("nan")), (None, 2.0)], "s string, v double")
    got = {r["column"]: r for r in P.prof_basic(df).collect()}
    assert got["s"]["null_rate"] == 0.25 and got["s"]["n_unique"] == 3
    assert got["v"]["null_rate"] == 0.5 and got["v"]["n_unique"] == 3
    cat = P.prof_categorical(df, ["s"], top_k=2).first()
    assert cat["n_unique"] == 3 and cat["top_values"] == "a:2, b:1"


def test_hist_equal_width(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)] + [(5.0,)], "x double")
    got = {r["bin"]: r["count"] for r in P.hist_equal_width(df, ["x"], 5).collect()}
    cnt, _ = np.histogram([float(i) for i in range(11)] + [5.0], bins=5)
    assert [got.get(i, 0) for i in range(5)] == cnt.tolist()


def test_qc_postcheck_duplicates(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 0), ("b", 1, None)], "id string, rn int, target int")
    got = {(r["metric"], r["key"]): r["value"] for r in P.qc_postcheck(df).collect()}
    assert got[("duplicates", None)] == 1.0
    assert got[("target_dist", "null")] == pytest.approx(1 / 3)


def test_one_hot_and_split_columns(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (None, 1)], "c int, enc_x int")
    out = SC.one_hot(df, ["c"])
    assert [c for c in out.columns if c.startswith("OHE")] == ["OHE_c_1", "OHE_c_2"]
    assert [tuple(r) for r in out.select("OHE_c_1", "OHE_c_2").collect()] == [(1, 0), (0, 1), (0, 0)]
    kinds = {r["column"]: (r["kind"], r["is_binary"]) for r in SC.split_columns(df).collect()}
    assert kinds == {"c": ("numeric", False), "enc_x": ("categorical", True)}


def test_prune_rule():
    cols = ["id", "paym_ok_share_3", "paym_ok_share_delta_3_12", "paym_late_share_6", "paym_late_share_3",
            "paym_last_status", "paym_last_late_recency", "paym_last_ok_recency", "util_x_overdue",
            "enc_paym_0", "enc_paym_2", "enc_paym_10", "enc_paym_3"]
    drop = SC.prune_columns(cols, drop_util_x_overdue=True)
    assert set(drop) == {"paym_ok_share_3", "paym_ok_share_delta_3_12", "paym_late_share_3", "paym_last_status",
                         "paym_last_ok_recency", "util_x_overdue", "enc_paym_10"}


def test_band_matches_qcut_rule(spark):
    import pandas as pd
    vals = [0.0, 0.0, 0.0, 0.1, 0.2, 0.2, 0.5, 0.9, 1.5, 3.0, None]
    edges = sorted(set(np.percentile([v for v in vals if v is not None], np.linspace(0, 100, 5))))
    df = spark.createDataFrame([(v,) for v in vals], "u double")
    got = [r[0] for r in df.select(band_expr(F.col("u"), edges)).collect()]
    exp = pd.qcut(pd.Series(vals), 4, labels=False, duplicates="drop").tolist()
    assert [None if (e is None or (isinstance(e, float) and math.isnan(e))) else int(e) for e in exp] == got


def test_stratified_split_exact_counts(spark):
    rows = [(str(i), 1, int(i % 10 == 0)) for i in range(500)]
    df = spark.createDataFrame(rows, "id string, rn int, target int")
    out = SM.stratified_split(df, 0.2, 42, "target")
    got = {r["target"]: r["n"] for r in out.filter("is_valid").groupBy("target").agg(F.count("*").alias("n")).collect()}
    assert got == {0: math.ceil(450 * 0.2), 1: math.ceil(50 * 0.2)}
    again = SM.stratified_split(df.repartition(7), 0.2, 42, "target")
    assert sorted(r["id"] for r in out.filter("is_valid").collect()) == \
        sorted(r["id"] for r in again.filter("is_valid").collect())


def test_sample_n_exact(spark):
    df = spark.createDataFrame([(str(i), 1) for i in range(300)], "id string, rn int")
    a = SM.sample_n(df, 50)
    assert a.count() == 50
    assert sorted(r["id"] for r in a.collect()) == sorted(r["id"] for r in SM.sample_n(df.repartition(5), 50).collect())
