"""Ranking metrics against brute force; quantiles against numpy; running totals against pandas."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import metrics as M
from ledgerlens.operators.cumulative import global_index, running_totals
from ledgerlens.operators import quantiles as Q
from ledgerlens.operators.quantiles import exact_quantiles, quantile_table


def scored_rows(n=400, seed=3):
    rng = random.Random(seed)
    return [(str(i), 1, int(rng.random() < 0.3), round(rng.random(), 1)) for i in range(n)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(scored_rows(), "id string, rn int, target int, pred_proba double")


def brute_auc(rows):
    pos = [s for _, _, y, s in rows if y == 1]
    neg = [s for _, _, y, s in rows if y == 0]
    tot = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p, q in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def brute_curve(rows):
    thr = sorted({s for *_, s in rows})
    P = sum(y for _, _, y, _ in rows)
    out = []
    for t in thr:
        tp = sum(1 for _, _, y, s in rows if s >= t and y == 1)
        fp = sum(1 for _, _, y, s in rows if s >= t and y == 0)
        out.append((t, tp, fp))
    return out, P


def test_roc_auc(scored):
    assert M.roc_auc(scored).first()["roc_auc"] == pytest.approx(brute_auc(scored_rows()), abs=1e-12)


def test_average_precision_and_f1(scored):
    curve, P = brute_curve(scored_rows())
    ap = 0.0
    prev_tp = 0
    for t, tp, fp in sorted(curve, key=lambda x: -x[0]):
        ap += (tp - prev_tp) / P * (tp / (tp + fp))
        prev_tp = tp
    assert M.average_precision(scored).first()["auc_pr"] == pytest.approx(ap, abs=1e-12)
    f1s = []
    for t, tp, fp in curve:
        p, r = tp / (tp + fp), tp / P
        f1s.append((2 * p * r / (p + r + 1e-12), t))
    best = max(f for f, _ in f1s)
    thr = min(t for f, t in f1s if f == best)
    got = M.best_f1(scored).first()
    assert got["best_f1"] == pytest.approx(best, abs=1e-12)
    assert got["best_threshold"] == thr
    ev = M.evaluate_binary(scored).first()
    assert ev["n_samples"] == 400 and ev["best_threshold"] == thr


def test_roc_curve_points(scored):
    curve, P = brute_curve(scored_rows())
    N = 400 - P
    pts = sorted(((t, fp / N, tp / P) for t, tp, fp in curve), key=lambda x: -x[0])
    got = M.roc_curve(scored, drop_intermediate=False).collect()
    rows = sorted([(r["threshold"], r["fpr"], r["tpr"]) for r in got], key=lambda x: -x[0])
    assert rows[0] == (float("inf"), 0.0, 0.0)
    assert len(rows) == len(pts) + 1
    for a, b in zip(rows[1:], pts):
        assert a == pytest.approx(b)
    kept = M.roc_curve(scored).count()
    assert 2 <= kept <= len(pts) + 1


def test_youden(scored):
    curve, P = brute_curve(scored_rows())
    N = 400 - P
    cands = [(tp / P - fp / N, t) for t, tp, fp in curve] + [(0.0, float("inf"))]
    best = max(j for j, _ in cands)
    thr = max(t for j, t in cands if j == best)
    assert M.youden_threshold(scored).first()["youden_threshold"] == thr


def test_running_totals_match_pandas(spark):
    rng = random.Random(1)
    rows = [(g, float(i) + rng.random(), rng.randint(0, 9)) for g in ("a", "b") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k double, v int")
    got = {(r["g"], r["k"]): r["cum_v"] for r in running_totals(df, "k", ["v"], ["g"], n_parts=7).collect()}
    for g in ("a", "b"):
        acc = 0
        for _, k, v in sorted(x for x in rows if x[0] == g):
            acc += v
            assert got[(g, k)] == acc
    idx = global_index(df, "k", descending=True, partition_cols=["g"], n_parts=5).collect()
    assert sorted(r["pos"] for r in idx if r["g"] == "a") == list(range(1, 301))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=999).round(2).tolist() + [None, float("nan")]
    y = rng.integers(0, 5, size=1001).tolist()
    df = spark.createDataFrame(list(zip(x, y)), "x double, y long")
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    answers = []
    for parts in (1, 8, 23):              # values do not depend on the number of partitions, to the last bit
        got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, ["x", "y"], probs, parts).collect()}
        answers.append(got)
        xs = np.array([v for v in x if v is not None and v == v])
        for p in probs:
            assert got[("x", p)] == pytest.approx(np.percentile(xs, p * 100), abs=1e-9)
            assert got[("y", p)] == pytest.approx(np.percentile(np.array(y), p * 100), abs=1e-9)
    assert answers[0] == answers[1] == answers[2]
    assert quantile_table(df, ["x"], [0.5]).first()["value"] == pytest.approx(
        np.median([v for v in x if v is not None and v == v]))


def test_one_class_ties_and_long_counts(spark):
    for y in (0, 1):
        df = spark.createDataFrame([(y, 0.1 * i) for i in range(5)], "target int, pred_proba double")
        assert M.roc_auc(df).first()["roc_auc"] is None
        assert M.average_precision(df).first()["auc_pr"] == pytest.approx(float(y))
        assert M.evaluate_binary(df).first()["roc_auc"] is None
        assert M.roc_curve(df).count() >= 2 and M.pr_curve(df).count() == 6
        assert M.best_f1(df).first()["best_f1"] is not None
    tied = spark.createDataFrame([(i % 2, 0.5) for i in range(10)], "target int, pred_proba double")
    assert M.roc_auc(tied).first()["roc_auc"] == pytest.approx(0.5)
    by = {r["g"]: r["roc_auc"] for r in M.roc_auc_by(
        spark.createDataFrame([("a", 0, 0.1), ("a", 1, 0.9), ("b", 1, 0.1), ("b", 0, 0.9), ("c", 1, 0.3)],
                              "g string, target int, pred_proba double"), ["g"]).collect()}
    assert by == {"a": 1.0, "b": 0.0, "c": None}
    # products of counts beyond 64 bits are taken as doubles
    big = spark.createDataFrame([(4 * 10 ** 9, 4 * 10 ** 9, 0, 0, 4 * 10 ** 9, 4 * 10 ** 9, 1.0)],
                                "pos long, neg long, tps long, fps long, P long, N long, thr double")
    assert big.agg(M._auc().alias("a")).first()["a"] == pytest.approx(1.5)


def test_split_keeps_unlabelled_rows_and_weights_skip_them(spark):
    from ledgerlens.operators import sampling as SM
    rows = [(i, 1, None if i % 7 == 0 else i % 3 == 0) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, rn int, b boolean").withColumn("target", F.col("b").cast("int")).drop("b")
    out = SM.stratified_split(df, 0.2).collect()
    assert len(out) == 300
    for c in (0, 1):
        n = sum(r["target"] == c for r in out)
        assert sum(bool(r["is_valid"]) for r in out if r["target"] == c) == -(-n // 5)
    assert all(r["is_valid"] is None for r in out if r["target"] is None)
    w = SM.balanced_weights(df).collect()
    assert len(w) == 300 and all(r["weight"] is None for r in w if r["target"] is None)
    assert sum(r["weight"] for r in w if r["weight"]) == pytest.approx(sum(r["target"] is not None for r in w))
    assert SM.sample_n(df, 17, keys=["id"]).count() == 17 and SM.sample_n(df, 1000, keys=["id"]).count() == 300


def test_selection_moves_a_small_share(spark):
    """100,000 rows of three columns: few values lie in the brackets, ties are counted before they move."""
    import numpy as np
    df = spark.range(100_000, numPartitions=7).selectExpr("rand(3) AS x", "randn(4) * 1e9 AS y", "cast(id % 3 as int) AS z").cache()
    probs = [0.0, 0.01, 0.333, 0.5, 0.99, 1.0]
    data = df.toPandas()
    got = {(r["column"], r["p"]): r["value"] for r in exact_quantiles(df, ["x", "y", "z"], probs).collect()}
    for c in "xyz":
        for p in probs:
            assert got[c, p] == np.percentile(data[c].astype(float), 100 * p)
    clean = Q._clean(df, ["x", "y"])
    _, found = Q.brackets(clean, [(i, p) for i in (0, 1) for p in probs], 2.0 / Q.SKETCH)
    assert Q.inside(clean, list(found.items())).count() < 0.01 * 200_000
    df.unpersist()


def test_missed_bracket_is_widened(spark, monkeypatch):
    import numpy as np
    values = [float(i * i % 101) for i in range(1000)] + [float("inf"), float("-inf"), 0.1, -0.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    real, seen = Q.brackets, []

    def off(clean, keys, slack):
        n, found = real(clean, keys, slack)
        seen.append(len(keys))
        if len(seen) == 1:
            found = {k: (50.0, 50.0) for k in found}
        return n, found
    monkeypatch.setattr(Q, "brackets", off)
    got = {r["p"]: r["value"] for r in exact_quantiles(df, ["x"], [0.1, 0.25, 0.9]).collect()}
    assert got == {p: np.percentile(values, 100 * p) for p in (0.1, 0.25, 0.9)} and len(seen) >= 2
    assert exact_quantiles(df.limit(0), ["x"], [0.5]).count() == 0
