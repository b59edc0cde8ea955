"""Oracle SQL text per registered query name (DuckDB dialect)."""

from __future__ import annotations

from typing import Dict, List

from oracles.sql import (CP_COLS, CP_NUMERIC, LABELS_CTE, N, base_cte, cp_ctes, d, decay_name,
                         events_cte, finish, is_float, latest_cte, pruned, rnd, v1_dataset_ctes,
                         v1_feature_ctes, v2_ctes)

NUM_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax"]

SEQ_NAMES = ["paym_ok_share_3", "paym_late_share_3", "paym_ok_share_6", "paym_late_share_6", "paym_ok_share_12",
             "paym_late_share_12", "paym_ok_share_24", "paym_late_share_24", "paym_longest_ok_streak_24",
             "paym_longest_late_streak_24", "paym_last_late_recency", "paym_last_ok_recency", "paym_ok_trend_6"]
TRANS_NAMES = [f"paym_{x}_{k}" for k in (3, 6, 12, 24) for x in ("transitions", "late_std", "any_late")] + \
    ["paym_late_time_decay", "paym_ok_share_delta_3_12", "paym_ok_share_delta_6_12"]
LIMIT_NAMES = ["overdue_to_limit", "maxover_to_limit", "outstanding_to_limit", "nextpay_to_limit"]
REST_NAMES = ["overdue_ratio", "nextpay_ratio", "bucket_severity_score", "has_recent_90p", "util_x_overdue",
              "util_x_outstanding", "zero_flags_sum", "zero_no_30plus_overdue", "util_log1p", "outstanding_log1p",
              "total_overdue_log1p", "nextpay_log1p", "paym_late_momentum_6", "paym_late_momentum_12",
              "paym_late_momentum_24", "paym_late_time_decay_088", "paym_late_time_decay_095",
              "paym_late_time_decay_07", "overdue_to_outstanding", "maxover_to_outstanding", "credit_headroom",
              "flag_recently_late", "flag_high_util_recently", "flag_clean_but_high_util",
              "age_since_opened_minus_confirmed", "recency_x_total_overdue", "late6_x_util"]
V2_NAMES = SEQ_NAMES + TRANS_NAMES + LIMIT_NAMES + REST_NAMES
V1_NAMES = SEQ_NAMES + LIMIT_NAMES + ["bucket_severity_score", "has_recent_90p"]
PAYM_FEATS = SEQ_NAMES + TRANS_NAMES + ["paym_late_momentum_6", "paym_late_momentum_12", "paym_late_momentum_24",
                                        "paym_late_time_decay_088", "paym_late_time_decay_095",
                                        "paym_late_time_decay_07"]
SMALLINT_NAMES = {"paym_longest_ok_streak_24", "paym_longest_late_streak_24", "zero_flags_sum",
                  *[f"paym_transitions_{k}" for k in (3, 6, 12, 24)], "util_band_q10"}
TINYINT_NAMES = {"has_recent_90p", "zero_no_30plus_overdue", "flag_recently_late", "flag_high_util_recently",
                 "flag_clean_but_high_util", *[f"paym_any_late_{k}" for k in (3, 6, 12, 24)]}


def type_of(c: str) -> str:
    if c == "id":
        return "VARCHAR"
    if c == "o_orderkey":
        return "BIGINT"
    if is_float(c):
        return "FLOAT"
    if c in SMALLINT_NAMES:
        return "SMALLINT"
    if c in TINYINT_NAMES:
        return "TINYINT"
    return "INT"


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CP = cp_ctes()
LATEST = f"{CP},\n{latest_cte()}"
SQL: Dict[str, str] = {}


def reg(name: str, sql: str) -> None:
    SQL[name] = sql


# ---------------------------------------------------------------- 2.1
reg("scan_parquet", f"SELECT l_orderkey, l_partkey, {rnd('l_quantity', 'l_quantity')}, "
                    f"{rnd('l_extendedprice', 'l_extendedprice')} FROM lineitem")
reg("scan_sample_head", f"SELECT o_orderkey, o_custkey, {rnd('o_totalprice', 'o_totalprice')} FROM orders "
                        f"ORDER BY o_orderkey LIMIT 1000")
reg("scan_shards", W(CP) + "SELECT id, rn, o_orderkey, CASE WHEN o_orderkey % 12 >= 6 THEN NULL ELSE "
                           "pre_loans_next_pay_summ END AS pre_loans_next_pay_summ, CAST(o_orderkey % 12 AS INT) AS shard "
                           "FROM credit_products")
reg("scan_widened", W(CP) + "SELECT id, CAST(rn AS BIGINT) AS rn, o_orderkey, "
    + rnd("CASE WHEN o_orderkey % 3 = 1 THEN CAST(pre_loans_outstanding AS DOUBLE) / 4 ELSE pre_loans_outstanding END", "pre_loans_outstanding")
    + ", CASE WHEN o_orderkey % 3 = 2 THEN 't' ELSE '' END || CAST(enc_loans_credit_type AS VARCHAR) AS enc_loans_credit_type, "
      "CASE WHEN o_orderkey % 3 > 0 THEN pre_loans5 END AS pre_loans5 FROM credit_products")
reg("scan_csv_labels", W(LABELS_CTE) + "SELECT id, CAST(flag AS TINYINT) AS target FROM labels_credit")
reg("scan_by_suffix", W(LABELS_CTE) + "SELECT id, flag FROM labels_credit")
_SHARD_EXPECTED = ["pre_loans_outstanding", "pre_loans_next_pay_summ", "pre_since_confirmed", "enc_paym_1",
                   "enc_paym_24"]
_shard_parts = " UNION ALL ".join(
    f"SELECT shard, n_rows, '{c}' AS \"column\", "
    + rnd(f"nr_{c}", "null_rate") + " FROM sp" for c in _SHARD_EXPECTED)
reg("shard_profile", W(CP, "sp AS (SELECT CAST(o_orderkey % 12 AS INT) AS shard, COUNT(*) AS n_rows, "
                       + ", ".join(
                           (f"AVG(CASE WHEN {c} IS NULL OR o_orderkey % 12 >= 6 THEN 1.0 ELSE 0.0 END) AS nr_{c}"
                            if c == "pre_loans_next_pay_summ" else
                            f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS nr_{c}") for c in _SHARD_EXPECTED)
                       + " FROM credit_products GROUP BY 1)") + _shard_parts)
_ROLL = "CASE WHEN o_orderkey % 12 >= 6 THEN NULL ELSE pre_loans_next_pay_summ END"
reg("profile_rollup", W(CP) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) AS n_rows, "
    + rnd(f"AVG(CASE WHEN {x} IS NULL THEN 1.0 ELSE 0.0 END)", "null_rate") + ", "
    + (", ".join([rnd("NULL", "lo"), rnd("NULL", "hi"), f"MIN({x}) AS lo_text", f"MAX({x}) AS hi_text"]) if c == "id" else
       ", ".join([rnd(f"MIN({x})", "lo"), rnd(f"MAX({x})", "hi"), "CAST(NULL AS VARCHAR) AS lo_text", "CAST(NULL AS VARCHAR) AS hi_text"]))
    + " FROM credit_products"
    for c in CP_COLS for x in [_ROLL if c == "pre_loans_next_pay_summ" else c]))
reg("sink_parquet", W(events_cte()) + "SELECT * FROM paym_events")
SCORED = f"""scored AS (
  SELECT c.id, c.rn, l.flag AS target,
    FLOOR(CAST(COALESCE(c.pre_loans_outstanding, 0) * 100 AS DOUBLE) / c.pre_loans_credit_limit) / 100 AS pred_proba
  FROM credit_products c JOIN labels_credit l ON c.id = l.id)"""
reg("sink_csv", W(CP, LABELS_CTE, SCORED) + f"SELECT id, rn, target, {rnd('pred_proba', 'pred_proba')} FROM scored")

# ranking tables over the scored rows
TABLE = """st AS (
  SELECT pred_proba AS thr, SUM(target) AS pos, SUM(1 - target) AS neg FROM scored
  WHERE pred_proba IS NOT NULL AND target IS NOT NULL GROUP BY pred_proba),
tot AS (SELECT SUM(pos) AS P, SUM(neg) AS N FROM st),
cum AS (
  SELECT st.*, tot.P, tot.N,
    SUM(pos) OVER (ORDER BY thr DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tps,
    SUM(neg) OVER (ORDER BY thr DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fps
  FROM st, tot)"""
# Mann-Whitney form of the AUC: average ranks of the positives
AUC = """rk AS (
  SELECT target, (RANK() OVER (ORDER BY pred_proba) + RANK() OVER (ORDER BY pred_proba)
     + COUNT(*) OVER (PARTITION BY pred_proba) - 1) / 2.0 AS r
  FROM scored WHERE pred_proba IS NOT NULL AND target IS NOT NULL),
auc AS (
  SELECT (SUM(CASE WHEN target = 1 THEN r ELSE 0 END) - SUM(target) * (SUM(target) + 1) / 2.0)
         / (CAST(SUM(target) AS DOUBLE) * SUM(1 - target)) AS roc_auc FROM rk)"""
AP = "ap AS (SELECT SUM(CAST(pos AS DOUBLE) / P * (CAST(tps AS DOUBLE) / (tps + fps))) AS auc_pr FROM cum)"
F1 = f"""f1t AS (
  SELECT thr, (CAST(2 AS DOUBLE) * (CAST(tps AS DOUBLE) / (tps + fps)) * (CAST(tps AS DOUBLE) / P))
     / ((CAST(tps AS DOUBLE) / (tps + fps)) + (CAST(tps AS DOUBLE) / P) + {d(1e-12)}) AS f1 FROM cum),
f1 AS (SELECT MAX(f1) AS best_f1, MIN(thr) FILTER (WHERE f1 = (SELECT MAX(f1) FROM f1t)) AS best_threshold FROM f1t)"""
EVAL = W(CP, LABELS_CTE, SCORED, TABLE, AUC, AP, F1) + (
    f"SELECT 'score_ratio' AS name, {rnd('roc_auc', 'roc_auc')}, {rnd('auc_pr', 'auc_pr')}, "
    f"{rnd('best_f1', 'best_f1')}, {rnd('COALESCE(best_threshold, 0.5)', 'best_threshold')}, "
    f"(SELECT CAST(SUM(pos + neg) AS BIGINT) FROM st) AS n_samples FROM auc, ap, f1")
reg("sink_json_report", EVAL)

# ---------------------------------------------------------------- 2.2
reg("normalize_id", "SELECT CAST(user_id AS VARCHAR) AS id, event_id FROM events")
reg("harmonize_dtypes", W(CP) + "SELECT * FROM credit_products")
reg("sanitize_dtypes", W(CP) + "SELECT * FROM credit_products")
reg("downcast_numeric", "SELECT " + ", ".join(
    rnd(f"CAST({c} AS FLOAT)", c) if c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax") else c
    for c in NUM_LI) + " FROM lineitem")
reg("add_nan_flags", W(CP) + "SELECT *, " + ", ".join(
    f"CAST(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS TINYINT) AS {c}_isnan" for c in CP_NUMERIC if c != "rn")
    + " FROM credit_products")
reg("cleanup_base", W(LATEST, base_cte()) + finish("base", CP_COLS + ["paym_last_status", "paym_last_clean_streak"]))
reg("cleanup_ext", "SELECT l_orderkey, l_linenumber, "
                   + rnd("CASE WHEN l_discount = 0 THEN NULL ELSE l_quantity / l_discount END", "qty_per_discount")
                   + ", " + rnd("CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END", "tax") + " FROM lineitem")
reg("impute_sentinel", W(LATEST, v1_feature_ctes("latest")) + "SELECT id, rn, "
    + rnd(f"COALESCE(paym_last_late_recency, {d(25)})", "paym_last_late_recency") + ", "
    + rnd(f"COALESCE(paym_last_ok_recency, {d(25)})", "paym_last_ok_recency") + " FROM f1")
_OHE = [("enc_loans_credit_type", v) for v in range(1, 6)] + [("enc_loans_credit_status", v) for v in range(3)]
reg("one_hot", W(CP) + "SELECT id, rn, " + ", ".join(
    f"CAST(CASE WHEN {c} = {v} THEN 1 ELSE 0 END AS TINYINT) AS OHE_{c}_{v}" for c, v in _OHE)
    + " FROM credit_products")
reg("one_hot_sparse", """WITH cat AS (
  SELECT col, v, ROW_NUMBER() OVER (PARTITION BY col ORDER BY v) - 1 AS code, COUNT(*) OVER (PARTITION BY col) AS n FROM (
    SELECT DISTINCT 1 AS col, CAST(o_custkey AS VARCHAR) AS v FROM orders WHERE o_orderkey % 3 > 0
    UNION ALL SELECT DISTINCT 2, o_orderpriority FROM orders WHERE o_orderkey % 3 > 0))
SELECT o_orderkey, CONCAT_WS(',', CAST(a.code AS VARCHAR), CAST(b.code + (SELECT MAX(n) FROM cat WHERE col = 1) AS VARCHAR)) AS slots
FROM orders LEFT JOIN cat a ON a.col = 1 AND a.v = CAST(o_custkey AS VARCHAR) LEFT JOIN cat b ON b.col = 2 AND b.v = o_orderpriority""")
_V2_SENT = ("v2s AS (SELECT * REPLACE (COALESCE(paym_last_late_recency, CAST(25 AS FLOAT)) AS paym_last_late_recency, "
            "COALESCE(paym_last_ok_recency, CAST(25 AS FLOAT)) AS paym_last_ok_recency) FROM v2)")
reg("prune_features", W(LATEST, v2_ctes("latest"), _V2_SENT) + finish("v2s", pruned(CP_COLS + V2_NAMES, False)))
reg("trial_frame", W(CP) + "SELECT id, rn, pre_loans_credit_limit, pre_loans_outstanding, enc_paym_0, enc_paym_1, "
                           "enc_paym_2, is_zero_loans90, pre_loans90 FROM credit_products ORDER BY id, rn LIMIT 1000")
_split_parts = ["SELECT 'id' AS \"column\", 'categorical' AS kind, false AS is_binary"] + [
    f"SELECT '{c}', '{'categorical' if 'enc_' in c else 'numeric'}', "
    f"COALESCE(BOOL_AND({c} IS NULL OR {c} IN (0, 1)), true) FROM credit_products" for c in CP_NUMERIC]
reg("split_columns", W(CP) + " UNION ALL ".join(_split_parts))
V1D = v1_dataset_ctes()
reg("filter_labelled", W(V1D) + "SELECT id, rn, target FROM v1 WHERE target IS NOT NULL")
reg("filter_equals_latest", W(CP) + "SELECT id, rn, rn_dup, o_orderkey FROM credit_products c WHERE rn_dup = "
                                    "(SELECT MAX(rn_dup) FROM credit_products c2 WHERE c2.id = c.id)")

# ---------------------------------------------------------------- 2.3
reg("join_labels_left", W(LATEST, LABELS_CTE) + "SELECT t.id, t.rn, t.o_orderkey, CAST(l.flag AS TINYINT) AS target "
                        "FROM latest t LEFT JOIN (SELECT id, MAX(flag) AS flag FROM labels_credit GROUP BY id) l "
                        "ON t.id = l.id")
reg("join_latest_semi", W(CP) + "SELECT id, rn, o_orderkey FROM credit_products c WHERE rn = "
                                "(SELECT MAX(rn) FROM credit_products c2 WHERE c2.id = c.id)")
reg("join_paym_aligned", W(events_cte(), v2_ctes("paym_events", seq_only=True)) + finish("v2", ["id", "rn"] + PAYM_FEATS))
reg("join_paym_history", SQL["join_paym_aligned"])
reg("label_gap", W(CP, LABELS_CTE) + "SELECT DISTINCT id FROM credit_products WHERE id NOT IN "
                                     "(SELECT id FROM labels_credit)")

# ---------------------------------------------------------------- 2.4
reg("agg_max_by_id", W(CP) + "SELECT id, MAX(rn) AS max_rn FROM credit_products GROUP BY id")
_LI_ALL = NUM_LI + ["l_returnflag", "l_linestatus", "l_shipdate"]
reg("prof_basic", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT(*) AS n_rows, {len(_LI_ALL)} AS n_cols, "
    + rnd(f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)", "null_rate")
    + f", CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unique FROM lineitem"
    for c in _LI_ALL))
_PCT = [(0.01, "p1"), (0.05, "p5"), (0.5, "p50"), (0.95, "p95"), (0.99, "p99")]
reg("prof_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", COUNT({c}) AS count, {rnd(f'AVG({c})', 'mean')}, {rnd(f'STDDEV_SAMP({c})', 'std')}, "
    f"{rnd(f'MIN({c})', 'min')}, "
    + ", ".join(rnd(f"quantile_cont({c}, {d(p)})", nm) for p, nm in _PCT)
    + f", {rnd(f'MAX({c})', 'max')} FROM lineitem" for c in NUM_LI))
reg("prof_categorical", """WITH vals AS (
  SELECT 'o_orderstatus' AS "column", o_orderstatus AS value FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders),
cnt AS (SELECT "column", value, COUNT(*) AS n FROM vals GROUP BY "column", value),
rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY "column" ORDER BY n DESC, value ASC NULLS LAST) AS pos FROM cnt)
SELECT "column", (SELECT COUNT(*) FROM cnt c2 WHERE c2."column" = rk."column") AS n_unique,
  STRING_AGG(COALESCE(value, 'nan') || ':' || CAST(n AS VARCHAR), ', ' ORDER BY pos) AS top_values
FROM rk WHERE pos <= 5 GROUP BY 1""")
_miss = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) AS null_rate "
                           f"FROM credit_products" for c in CP_COLS)
reg("prof_missing_top", W(CP, f"m AS ({_miss})") + "SELECT \"column\", " + rnd("null_rate", "null_rate")
    + " FROM m ORDER BY null_rate DESC, \"column\" LIMIT 25")
_HIST = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_hist_parts = " UNION ALL ".join(f"""SELECT '{c}' AS "column", v, lo, hi FROM (
  SELECT CAST({c} AS DOUBLE) AS v,
    CASE WHEN MIN({c}) OVER () = MAX({c}) OVER () THEN MIN({c}) OVER () - 0.5 ELSE MIN({c}) OVER () END AS lo,
    CASE WHEN MIN({c}) OVER () = MAX({c}) OVER () THEN MAX({c}) OVER () + 0.5 ELSE MAX({c}) OVER () END AS hi
  FROM lineitem) WHERE v IS NOT NULL""" for c in _HIST)
reg("hist_equal_width", W(f"x AS ({_hist_parts})", """b AS (
  SELECT "column", lo, hi, CAST(LEAST(FLOOR((v - lo) * CAST(50 AS DOUBLE) / (hi - lo)), 49) AS INT) AS bin FROM x)""")
    + "SELECT \"column\", bin, " + rnd("lo + bin * ((hi - lo) / CAST(50 AS DOUBLE))", "lower") + ", "
    + rnd("lo + (bin + 1) * ((hi - lo) / CAST(50 AS DOUBLE))", "upper")
    + ", COUNT(*) AS count FROM b GROUP BY \"column\", bin, lo, hi")


def _corr(a: str, b: str) -> str:
    return f"CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE corr({a}, {b}) END"


_pairs = [(a, b) for i, a in enumerate(NUM_LI) for b in NUM_LI[i + 1:]]
reg("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd(_corr(f'CAST({a} AS DOUBLE)', f'CAST({b} AS DOUBLE)'), 'corr')} "
    f"FROM lineitem" for a, b in _pairs))
_cp_pairs = [(i, j, a, b) for i, a in enumerate(CP_NUMERIC) for j, b in enumerate(CP_NUMERIC) if i < j]
_cp_corr = " UNION ALL ".join(
    f"SELECT {i} AS ia, {j} AS ib, '{a}' AS col_a, '{b}' AS col_b, "
    f"ABS({_corr(f'CAST({a} AS DOUBLE)', f'CAST({b} AS DOUBLE)')}) AS abs_corr FROM credit_products"
    for i, j, a, b in _cp_pairs)
reg("corr_top_pairs", W(CP, f"pc AS ({_cp_corr})") + "SELECT col_a, col_b, " + rnd("abs_corr", "abs_corr")
    + ", abs_corr >= 0.98 AS flag_high FROM pc WHERE abs_corr IS NOT NULL "
      "ORDER BY ROUND(abs_corr, 9) DESC, ia, ib LIMIT 30")
_V1_NUM = [c for c in CP_NUMERIC if c != "rn"] + ["paym_last_status", "paym_last_clean_streak"]
_cwt = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {_corr(f'CAST({c} AS DOUBLE)', 'CAST(target AS DOUBLE)')} AS corr FROM v1"
    for c in _V1_NUM)
reg("corr_with_target", W(V1D, f"ct AS ({_cwt})") + "SELECT feature, " + rnd("corr", "corr") + ", "
    + rnd("ABS(corr)", "abs_corr") + " FROM ct WHERE corr IS NOT NULL ORDER BY ROUND(ABS(corr), 9) DESC, feature "
                                     "LIMIT 20")


def _identical_sql() -> str:
    cols = [c for c in CP_COLS + V2_NAMES if c not in ("id", "rn")]
    idx = {c: i for i, c in enumerate(cols)}
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:] if type_of(a) == type_of(b)]
    aggs = ", ".join(f"BOOL_AND({a} IS NOT DISTINCT FROM {b}) AS \"{idx[a]}_{idx[b]}\"" for a, b in pairs)
    names = ", ".join(f"({i}, '{c}')" for c, i in idx.items())
    return W(LATEST, v2_ctes("latest"), f"eqa AS (SELECT {aggs} FROM v2)",
             "eq AS (SELECT CAST(split_part(k, '_', 1) AS INT) AS a, CAST(split_part(k, '_', 2) AS INT) AS b "
             "FROM (UNPIVOT eqa ON COLUMNS(*) INTO NAME k VALUE same) WHERE same)",
             f"nm AS (SELECT * FROM (VALUES {names}) t(i, c))",
             "mem AS (SELECT a AS i FROM eq UNION SELECT b FROM eq)",
             "lead AS (SELECT mem.i, COALESCE((SELECT MIN(a) FROM eq WHERE eq.b = mem.i), mem.i) AS f FROM mem)") + \
        "SELECT n1.c AS \"column\", n2.c AS group_first FROM lead JOIN nm n1 ON n1.i = lead.i JOIN nm n2 ON n2.i = lead.f"


reg("identical_columns", _identical_sql())

_V1D_COLS = ["id", "rn", "rn_dup", "o_orderkey"] + [c for c in CP_COLS if c not in ("id", "rn", "rn_dup", "o_orderkey")] \
    + ["paym_last_status", "paym_last_clean_streak", "target"]
_nulls = " UNION ALL ".join(f"SELECT '{c}' AS c, SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS m FROM v1"
                            for c in _V1D_COLS)
reg("qc_postcheck", W(V1D, f"nul AS ({_nulls})", "n AS (SELECT COUNT(*) AS n FROM v1)") + f"""
SELECT 'rows' AS metric, CAST(NULL AS VARCHAR) AS key, {rnd('n', 'value')} FROM n
UNION ALL SELECT 'columns', NULL, {rnd(str(len(_V1D_COLS)), 'value')}
UNION ALL SELECT 'nans_total', NULL, {rnd('SUM(m)', 'value')} FROM nul
UNION ALL SELECT 'nan_rate_pct', NULL, {rnd(f'CAST(100 AS DOUBLE) * SUM(m) / ((SELECT n FROM n) * {len(_V1D_COLS)})', 'value')} FROM nul
UNION ALL SELECT * FROM (SELECT 'null_pct', c, {rnd('CAST(100 AS DOUBLE) * m / (SELECT n FROM n)', 'value')} FROM nul
  ORDER BY m DESC, c LIMIT 10)
UNION ALL SELECT 'duplicates', NULL, {rnd('SUM(k - 1)', 'value')} FROM (SELECT COUNT(*) AS k FROM v1 GROUP BY id, rn)
UNION ALL SELECT 'target_dist', COALESCE(CAST(target AS VARCHAR), 'null'), {rnd('COUNT(*) / (SELECT n FROM n)', 'value')}
  FROM v1 GROUP BY target""")
reg("qc_labels", W(V1D) + f"""SELECT COUNT(*) AS rows_total, COUNT(target) AS rows_with_target,
  {rnd('(CAST(COUNT(*) AS DOUBLE) - COUNT(target)) / COUNT(*)', 'missing_target_rate')},
  (SELECT COUNT(*) - COUNT(DISTINCT id) FROM labels_credit) AS label_dup_ids,
  (SELECT COUNT(DISTINCT id) FROM labels_credit) AS label_ids,
  {rnd('(SELECT AVG(CASE WHEN id IN (SELECT id FROM labels_credit) THEN 1.0 ELSE 0.0 END) FROM (SELECT DISTINCT id FROM v1))', 'label_coverage')}
FROM v1""")
reg("qc_cardinality", W(CP, LABELS_CTE) + f"""SELECT COUNT(*) AS rows, COUNT(DISTINCT id) AS unique_ids,
  {rnd('COUNT(*) / COUNT(DISTINCT id)', 'rows_per_id')},
  (SELECT COUNT(DISTINCT id) FROM credit_products WHERE id IN (SELECT id FROM labels_credit)) AS ids_with_label,
  {rnd('(SELECT COUNT(DISTINCT id) FROM credit_products WHERE id IN (SELECT id FROM labels_credit)) / COUNT(DISTINCT id)', 'id_coverage')}
FROM credit_products""")
reg("pos_rate", W(V1D) + f"SELECT {rnd('AVG(CAST(target AS DOUBLE))', 'pos_rate')}, COUNT(target) AS n FROM v1")
_caps_raw = ", ".join(
    f"CAST({s} AS DOUBLE) / (ABS(CAST(pre_loans_credit_limit AS DOUBLE)) + {d(1e-4)}) AS {dst}"
    for s, dst in (("pre_loans_total_overdue", "overdue_to_limit"), ("pre_loans_max_overdue_sum", "maxover_to_limit"),
                   ("pre_loans_outstanding", "outstanding_to_limit"), ("pre_loans_next_pay_summ", "nextpay_to_limit")))
reg("percentile_caps", W(LATEST, f"r AS (SELECT {_caps_raw} FROM latest)") + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {rnd(f'quantile_cont({c}, {d(0.01)})', 'lo')}, "
    f"{rnd(f'quantile_cont({c}, {d(0.99)})', 'hi')} FROM r" for c in LIMIT_NAMES))

# ---------------------------------------------------------------- 2.5
reg("latest_record", W(LATEST) + "SELECT * FROM latest")
reg("dedupe_keep_last", W(CP) + """SELECT * EXCLUDE (_r) FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY id, rn_dup ORDER BY (pre_since_opened IS NULL) DESC, pre_since_opened DESC,
    (pre_since_confirmed IS NULL) DESC, pre_since_confirmed DESC, o_orderkey DESC) AS _r
  FROM credit_products) WHERE _r = 1""")
reg("sort_topk", W(LATEST) + "SELECT id, rn, pre_loans_outstanding FROM latest "
                             "ORDER BY pre_loans_outstanding DESC NULLS LAST, id LIMIT 20")
reg("util_band", W(LATEST, v2_ctes("latest", band_bins=10)) + "SELECT id, rn, util_band_q10 FROM v2")
reg("sample_n", W(CP) + "SELECT id, rn, o_orderkey FROM credit_products "
                        "ORDER BY md5(concat_ws('|', id, CAST(rn AS VARCHAR), '42')) LIMIT 500")
UNIT = "CAST(('0x' || SUBSTR(md5(concat_ws('|', id, CAST(rn AS VARCHAR), '42')), 1, 13))::BIGINT AS DOUBLE) " \
       "/ CAST(4503599627370496 AS DOUBLE)"
reg("stratified_split", W(V1D, f"""s AS (
  SELECT id, rn, target, ROW_NUMBER() OVER (PARTITION BY target ORDER BY {UNIT}, id, rn) AS pos,
    COUNT(*) OVER (PARTITION BY target) AS nc
  FROM v1 WHERE target IS NOT NULL)""") + "SELECT id, rn, target, pos <= CEIL(CAST(nc AS DOUBLE) * CAST('0.2' AS DOUBLE)) AS is_valid FROM s")

# ---------------------------------------------------------------- 2.6
reg("union_shards", W(CP) + "SELECT * REPLACE (CASE WHEN o_orderkey % 2 = 1 THEN NULL ELSE pre_loans_next_pay_summ "
                            "END AS pre_loans_next_pay_summ) FROM credit_products")
reg("intersect_ids", W(CP, LABELS_CTE) + "SELECT DISTINCT id FROM credit_products WHERE id IN "
                                         "(SELECT id FROM labels_credit)")


def _diff_sql() -> str:
    common = [c for c in CP_COLS if c not in ("id", "rn") and c not in [f"enc_paym_{i}" for i in range(20, 25)]]
    b = ("b AS (SELECT * EXCLUDE (enc_paym_20, enc_paym_21, enc_paym_22, enc_paym_23, enc_paym_24) "
         "REPLACE (CASE WHEN rn = 1 THEN pre_loans_outstanding + 1 ELSE pre_loans_outstanding END "
         "AS pre_loans_outstanding), rn * 2 AS extra FROM credit_products WHERE o_orderkey % 10 <> 0)")
    j = ("j AS (SELECT a.id IS NOT NULL AS in_a, b.id IS NOT NULL AS in_b, "
         + ", ".join(f"a.{c} AS a_{c}, b.{c} AS b_{c}" for c in common)
         + " FROM credit_products a FULL OUTER JOIN b ON a.id = b.id AND a.rn = b.rn)")
    meta = " UNION ALL ".join(
        [f"SELECT 'column_removed' AS section, 'enc_paym_{i}' AS name, CAST(NULL AS BIGINT) AS value"
         for i in range(20, 25)]
        + ["SELECT 'column_added', 'extra', NULL"]
        + [f"SELECT 'column_common', '{c}', NULL" for c in common])
    rows = ("SELECT 'rows', 'removed', CAST(SUM(CASE WHEN in_a AND NOT in_b THEN 1 ELSE 0 END) AS BIGINT) FROM j "
            "UNION ALL SELECT 'rows', 'added', CAST(SUM(CASE WHEN in_b AND NOT in_a THEN 1 ELSE 0 END) AS BIGINT) FROM j "
            "UNION ALL SELECT 'rows', 'common', CAST(SUM(CASE WHEN in_a AND in_b THEN 1 ELSE 0 END) AS BIGINT) FROM j")
    chg = " UNION ALL ".join(
        f"SELECT 'changed', '{c}', CAST(SUM(CASE WHEN in_a AND in_b AND a_{c} IS DISTINCT FROM b_{c} THEN 1 ELSE 0 END)"
        f" AS BIGINT) FROM j" for c in common)
    return W(CP, b, j) + f"{meta} UNION ALL {rows} UNION ALL {chg}"


reg("dataset_diff", _diff_sql())

# ---------------------------------------------------------------- 2.7 / 2.8 from the v2 relation over products
_V2CP = W(CP, v2_ctes("credit_products"))


def _bits(kind: str) -> str:
    vals = "0,1" if kind == "ok" else "2,3,4,5,6,7,8,9"
    return " || ".join(f"(CASE WHEN enc_paym_{i} IN ({vals}) THEN '1' ELSE '0' END)" for i in range(N))


reg("paym_binarize", W(CP) + f"SELECT id, rn, {_bits('ok')} AS ok_bits, {_bits('late')} AS late_bits "
                             "FROM credit_products")
reg("paym_last_status", W(CP, base_cte("credit_products")) + finish("base", ["id", "rn", "paym_last_status"]))
reg("paym_last_clean_streak", W(CP, base_cte("credit_products"))
    + finish("base", ["id", "rn", "paym_last_clean_streak"]))
_SEQ_Q = {
    "paym_share": [f"paym_{x}_share_{k}" for k in (3, 6, 12, 24) for x in ("ok", "late")],
    "paym_longest_streak": ["paym_longest_ok_streak_24", "paym_longest_late_streak_24"],
    "paym_recency": ["paym_last_late_recency", "paym_last_ok_recency"],
    "paym_trend": ["paym_ok_trend_6"],
    "paym_late_std": [f"paym_late_std_{k}" for k in (3, 6, 12, 24)],
    "paym_any_late": [f"paym_any_late_{k}" for k in (3, 6, 12, 24)],
    "paym_time_decay": ["paym_late_time_decay"],
    "paym_time_decay_multi": [decay_name(x) for x in (0.88, 0.95, 0.70)],
    "paym_share_delta": ["paym_ok_share_delta_3_12", "paym_ok_share_delta_6_12"],
    "paym_momentum": ["paym_late_momentum_6", "paym_late_momentum_12", "paym_late_momentum_24"],
    "ratio_to_limit": LIMIT_NAMES,
    "ratio_to_outstanding": ["overdue_ratio", "nextpay_ratio"],
    "cross_ratios": ["overdue_to_outstanding", "maxover_to_outstanding", "credit_headroom"],
    "bucket_severity": ["bucket_severity_score"],
    "has_recent_90p": ["has_recent_90p"],
    "util_interactions": ["util_x_overdue", "util_x_outstanding"],
    "interaction_grid": ["recency_x_total_overdue", "late6_x_util"],
    "log1p_features": ["util_log1p", "outstanding_log1p", "total_overdue_log1p", "nextpay_log1p"],
    "behavioral_flags": ["flag_recently_late", "flag_high_util_recently", "flag_clean_but_high_util"],
    "age_exposure": ["age_since_opened_minus_confirmed"],
    "zero_flag_aggs": ["zero_flags_sum", "zero_no_30plus_overdue"],
}
for _n, _cols in _SEQ_Q.items():
    reg(_n, _V2CP + finish("v2", ["id", "rn"] + _cols))
reg("paym_transitions", W(CP, "v2_b AS (SELECT *, " + ", ".join(
    f"(CASE WHEN enc_paym_{i} IN (2,3,4,5,6,7,8,9) THEN 1 ELSE 0 END) AS late_{i}" for i in range(N))
    + " FROM credit_products)") + "SELECT id, rn, " + ", ".join(
    f"CAST(({' + '.join(f'ABS(late_{i} - late_{i - 1})' for i in range(1, k))}) AS SMALLINT) AS paym_transitions_{k}"
    for k in (3, 6, 12, 24)) + ", CAST((" + " + ".join(
    f"(CASE WHEN late_{i} - late_{i - 1} = 1 THEN 1 WHEN late_{i} - late_{i - 1} = -1 THEN 255 ELSE 0 END)"
    for i in range(1, 24)) + ") AS SMALLINT) AS paym_transitions_compat_24 FROM v2_b")

# ---------------------------------------------------------------- composites
reg("features_base", W(LATEST, base_cte()) + finish("base", CP_COLS + ["paym_last_status", "paym_last_clean_streak"]))
reg("features_v1", W(LATEST, v1_feature_ctes("latest")) + finish("f1", CP_COLS + V1_NAMES))
reg("features_v2", W(LATEST, v2_ctes("latest")) + finish("v2", CP_COLS + V2_NAMES))
_NO_6 = {"paym_ok_share_6", "paym_ok_share_delta_6_12", "paym_transitions_6", "paym_late_std_6", "paym_any_late_6"}
_NO_LOGS = [c for c in V2_NAMES if not c.endswith("_log1p")]
reg("feature_catalogue_stats", W(LATEST, v2_ctes("latest")) + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", " + rnd(f"AVG(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)", "null_rate")
    + f", CAST(COUNT(DISTINCT {c}) + MAX(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_unique FROM v2"
    for c in _NO_LOGS))
reg("features_v2_windows", W(LATEST, v2_ctes("latest")) + finish("v2", CP_COLS + [c for c in V2_NAMES if c not in _NO_6]))
reg("dataset_v1", W(V1D) + finish("v1", _V1D_COLS))
_V1S = ("f1s AS (SELECT * REPLACE (COALESCE(paym_last_late_recency, CAST(25 AS FLOAT)) AS paym_last_late_recency, "
        "COALESCE(paym_last_ok_recency, CAST(25 AS FLOAT)) AS paym_last_ok_recency) FROM f1)")
reg("dataset_v2", W(V1D, v1_feature_ctes("v1"), _V1S) + finish("f1s", pruned(_V1D_COLS + V1_NAMES, False)))
_V3_IN = ("v3in AS (SELECT * EXCLUDE (" + ", ".join(V1_NAMES) + ") FROM f1)")
_V3S = ("v3s AS (SELECT * REPLACE (COALESCE(paym_last_late_recency, CAST(25 AS FLOAT)) AS paym_last_late_recency, "
        "COALESCE(paym_last_ok_recency, CAST(25 AS FLOAT)) AS paym_last_ok_recency) FROM v2)")
reg("dataset_v3", W(V1D, v1_feature_ctes("v1"), _V3_IN, v2_ctes("v3in", single_decay=0.88, band_bins=10), _V3S)
    + finish("v3s", pruned(_V1D_COLS + V2_NAMES + ["util_band_q10"], True)))

# ---------------------------------------------------------------- 2.9 metrics and preparation
reg("balanced_weights", W(V1D, "lab AS (SELECT id, rn, target FROM v1 WHERE target IS NOT NULL)",
                          "cc AS (SELECT target, COUNT(*) AS nc FROM lab GROUP BY target)",
                          "tt AS (SELECT SUM(nc) AS n, COUNT(*) AS k FROM cc)")
    + f"SELECT lab.id, lab.rn, lab.target, {rnd('tt.n / (tt.k * cc.nc)', 'weight')} FROM lab "
      "JOIN cc ON lab.target = cc.target CROSS JOIN tt")
_IMP = ["pre_loans_outstanding", "pre_since_confirmed", "enc_paym_12", "enc_paym_24"]
reg("impute_median", W(LATEST) + "SELECT id, rn, " + ", ".join(
    rnd(f"COALESCE(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, {d(0.5)}) FROM latest))", c) for c in _IMP)
    + " FROM latest")
_SCL = ["pre_loans_credit_limit", "pre_loans_outstanding", "pre_loans5", "is_zero_loans90"]
reg("scale_no_center", W(LATEST) + "SELECT id, rn, " + ", ".join(
    rnd(f"CAST({c} AS DOUBLE) / (SELECT CASE WHEN STDDEV_POP({c}) IS NULL OR STDDEV_POP({c}) = 0 THEN 1.0 "
        f"ELSE STDDEV_POP({c}) END FROM latest)", c) for c in _SCL) + " FROM latest")
SC_ = W(CP, LABELS_CTE, SCORED, TABLE)
reg("metric_roc_auc", W(CP, LABELS_CTE, SCORED, AUC) + f"SELECT {rnd('roc_auc', 'roc_auc')} FROM auc")
reg("metric_avg_precision", W(CP, LABELS_CTE, SCORED, TABLE, AP) + f"SELECT {rnd('auc_pr', 'auc_pr')} FROM ap")
reg("metric_best_f1", W(CP, LABELS_CTE, SCORED, TABLE, F1)
    + f"SELECT {rnd('best_f1', 'best_f1')}, {rnd('best_threshold', 'best_threshold')} FROM f1")
reg("roc_curve", SC_ + f""", pts AS (
  SELECT thr, tps, fps, P, N, LAG(tps) OVER (ORDER BY thr DESC) AS tp0, LAG(fps) OVER (ORDER BY thr DESC) AS fp0,
    LEAD(tps) OVER (ORDER BY thr DESC) AS tp2, LEAD(fps) OVER (ORDER BY thr DESC) AS fp2 FROM cum)
SELECT {rnd("CAST('inf' AS DOUBLE)", 'threshold')}, {rnd('0', 'fpr')}, {rnd('0', 'tpr')}
UNION ALL
SELECT {rnd('thr', 'threshold')}, {rnd('CAST(fps AS DOUBLE) / N', 'fpr')}, {rnd('CAST(tps AS DOUBLE) / P', 'tpr')}
FROM pts WHERE tp0 IS NULL OR tp2 IS NULL OR fp0 - 2 * fps + fp2 <> 0 OR tp0 - 2 * tps + tp2 <> 0""")
reg("pr_curve", SC_ + f"""SELECT {rnd('thr', 'threshold')}, {rnd('CAST(tps AS DOUBLE) / (tps + fps)', 'precision')},
  {rnd('CASE WHEN P > 0 THEN CAST(tps AS DOUBLE) / P ELSE 1.0 END', 'recall')} FROM cum
UNION ALL SELECT NULL, {rnd('1', 'precision')}, {rnd('0', 'recall')}""")
reg("youden_threshold", SC_ + f""", j AS (
  SELECT CAST('inf' AS DOUBLE) AS thr, CAST(0 AS DOUBLE) AS jj
  UNION ALL SELECT thr, CAST(tps AS DOUBLE) / P - CAST(fps AS DOUBLE) / N FROM cum)
SELECT {rnd('MAX(thr) FILTER (WHERE jj = (SELECT MAX(jj) FROM j))', 'youden_threshold')},
  {rnd('MAX(jj)', 'youden_j')} FROM j""")
reg("evaluate_binary", EVAL)

# ---------------------------------------------------------------- 2.10
reg("incremental_assembly", W(V1D) + finish(
    "(SELECT *, (SELECT COUNT(*) FROM v1) AS written, (SELECT COUNT(target) FROM v1) AS matched, "
    "(SELECT (COUNT(DISTINCT o_orderkey % 12) + 3) // 4 FROM credit_products) AS batches FROM v1)",
    _V1D_COLS + ["written", "matched", "batches"]))
reg("row_fn", W(CP) + "SELECT id, rn, " + rnd("CAST(pre_loans_outstanding AS DOUBLE) / pre_loans_credit_limit",
                                                "util_pd") + " FROM credit_products")

reg("row_fn_shards", W(CP) + "SELECT id, rn, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_orderkey % 12 ORDER BY o_orderkey) AS place "
                             "FROM credit_products")


def oracle_sql() -> Dict[str, str]:
    return dict(SQL)


def names() -> List[str]:
    return list(SQL)
