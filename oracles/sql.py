"""DuckDB SQL for the correctness oracles.

Written independently of the Spark code paths: unrolled CASE chains instead of
array folds, UNPIVOT + gaps-and-islands for streaks, ``quantile_cont`` for
percentiles, window functions for ranks.  The views ``region nation customer
supplier part orders lineitem events ...`` are registered by the checker.
"""

from __future__ import annotations

N = 25
OK_VALUES = (0, 1)
LATE_VALUES = (2, 3, 4, 5, 6, 7, 8, 9)
EPS = 1e-4
WINDOWS = (3, 6, 12, 24)


def d(x: float) -> str:
    """An exact DOUBLE literal (decimal literals would be DECIMAL in DuckDB)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def rnd(expr: str, name: str) -> str:
    return f"ROUND(CAST({expr} AS DOUBLE), 6) + CAST(0 AS DOUBLE) AS {name}"


PAYM = [f"enc_paym_{i}" for i in range(N)]


# ---------------------------------------------------------------- fixtures
def cp_ctes() -> str:
    lags = ",\n    ".join(f"LAG(code,{i}) OVER (PARTITION BY o_custkey ORDER BY seq) AS enc_paym_{i}"
                          for i in range(1, N))
    return f"""li AS (
  SELECT l_orderkey,
    CAST(SUM(CASE WHEN l_linestatus='O' THEN FLOOR(l_extendedprice) ELSE 0 END) AS INT) AS outstanding,
    CAST(SUM(CASE WHEN l_returnflag='R' THEN FLOOR(l_extendedprice) ELSE 0 END) AS INT) AS overdue,
    CAST(MAX(CASE WHEN l_returnflag='R' THEN FLOOR(l_extendedprice) ELSE 0 END) AS INT) AS max_overdue,
    CAST(MIN(FLOOR(l_extendedprice)) AS INT) AS next_pay,
    CAST(SUM(CASE WHEN ROUND(l_discount*100) IN (1,2) THEN 1 ELSE 0 END) AS INT) AS b5,
    CAST(SUM(CASE WHEN ROUND(l_discount*100) IN (3,4) THEN 1 ELSE 0 END) AS INT) AS b530,
    CAST(SUM(CASE WHEN ROUND(l_discount*100) IN (5,6) THEN 1 ELSE 0 END) AS INT) AS b3060,
    CAST(SUM(CASE WHEN ROUND(l_discount*100) IN (7,8) THEN 1 ELSE 0 END) AS INT) AS b6090,
    CAST(SUM(CASE WHEN ROUND(l_discount*100) >= 9 THEN 1 ELSE 0 END) AS INT) AS b90,
    CAST(GREATEST(ROUND(MAX(l_tax)*100)-4, 0) AS INT) AS code,
    MAX((2002-YEAR(l_shipdate))*12-MONTH(l_shipdate)) AS confirmed
  FROM lineitem GROUP BY l_orderkey),
p AS (
  SELECT o.*, li.*, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq
  FROM orders o LEFT JOIN li ON li.l_orderkey = o.o_orderkey),
credit_products AS (
  SELECT CAST(o_custkey AS VARCHAR) AS id, CAST(seq AS INT) AS rn, CAST(YEAR(o_orderdate)-1994 AS INT) AS rn_dup,
    o_orderkey,
    CAST(FLOOR(o_totalprice) AS INT) AS pre_loans_credit_limit, outstanding AS pre_loans_outstanding,
    overdue AS pre_loans_total_overdue, max_overdue AS pre_loans_max_overdue_sum, next_pay AS pre_loans_next_pay_summ,
    b5 AS pre_loans5, b530 AS pre_loans530, b3060 AS pre_loans3060, b6090 AS pre_loans6090, b90 AS pre_loans90,
    CASE WHEN b3060=0 THEN 1 ELSE 0 END AS is_zero_loans3060,
    CASE WHEN b6090=0 THEN 1 ELSE 0 END AS is_zero_loans6090,
    CASE WHEN b90=0 THEN 1 ELSE 0 END AS is_zero_loans90,
    CAST((2002-YEAR(o_orderdate))*12-MONTH(o_orderdate) AS INT) AS pre_since_opened,
    CAST(confirmed AS INT) AS pre_since_confirmed,
    CAST(SUBSTR(o_orderpriority,1,1) AS INT) AS enc_loans_credit_type,
    CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS enc_loans_credit_status,
    code AS enc_paym_0,
    {lags}
  FROM p)"""


CP_COLS = ["id", "rn", "rn_dup", "o_orderkey", "pre_loans_credit_limit", "pre_loans_outstanding",
           "pre_loans_total_overdue", "pre_loans_max_overdue_sum", "pre_loans_next_pay_summ", "pre_loans5",
           "pre_loans530", "pre_loans3060", "pre_loans6090", "pre_loans90", "is_zero_loans3060",
           "is_zero_loans6090", "is_zero_loans90", "pre_since_opened", "pre_since_confirmed",
           "enc_loans_credit_type", "enc_loans_credit_status"] + PAYM
CP_NUMERIC = [c for c in CP_COLS if c != "id"]

LABELS_CTE = """labels_credit AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS flag
  FROM customer WHERE c_nationkey <> 0)"""


def latest_cte(src: str = "credit_products", name: str = "latest", order: str = "rn") -> str:
    return f"""{name} AS (
  SELECT * EXCLUDE (_r) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY id ORDER BY {order} DESC,
      (pre_since_opened IS NULL) DESC, pre_since_opened DESC,
      (pre_since_confirmed IS NULL) DESC, pre_since_confirmed DESC, o_orderkey DESC) AS _r
    FROM {src} WHERE {order} IS NOT NULL) WHERE _r = 1)"""


def events_cte() -> str:
    slots = ",\n  ".join(f"MAX(CASE WHEN slot={i} THEN code END) AS enc_paym_{i}" for i in range(N))
    return f"""ev AS (
  SELECT user_id,
    CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END AS code,
    ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) - 1 AS slot
  FROM events),
paym_events AS (
  SELECT CAST(user_id AS VARCHAR) AS id, 1 AS rn,
  {slots}
  FROM ev GROUP BY user_id)"""


def base_cte(src: str = "latest", name: str = "base") -> str:
    """Base features: last status and the count of leading 0 statuses."""
    chain = " ".join(f"WHEN enc_paym_{i} IS NULL OR enc_paym_{i} <> 0 THEN {i}" for i in range(N))
    return f"""{name} AS (
  SELECT *, CAST(enc_paym_0 AS FLOAT) AS paym_last_status,
    CAST(CASE {chain} ELSE {N} END AS FLOAT) AS paym_last_clean_streak
  FROM {src})"""


def v1_dataset_ctes() -> str:
    """dataset_v1: latest product, base features, label; history as SMALLINT, o_orderkey as INT."""
    casts = ", ".join(f"CAST(enc_paym_{i} AS SMALLINT) AS enc_paym_{i}" for i in range(N))
    return f"""{cp_ctes()},
{LABELS_CTE},
{latest_cte()},
{base_cte()},
v1 AS (
  SELECT b.* EXCLUDE ({", ".join(PAYM)}, o_orderkey), CAST(b.o_orderkey AS INT) AS o_orderkey, {casts},
    CAST(l.flag AS TINYINT) AS target
  FROM base b LEFT JOIN (SELECT id, MAX(flag) AS flag FROM labels_credit GROUP BY id) l ON b.id = l.id)"""


# ---------------------------------------------------------------- sequence features
def _ok(i: int) -> str:
    return f"(CASE WHEN enc_paym_{i} IN ({','.join(map(str, OK_VALUES))}) THEN 1 ELSE 0 END)"


def _late(i: int) -> str:
    return f"(CASE WHEN enc_paym_{i} IN ({','.join(map(str, LATE_VALUES))}) THEN 1 ELSE 0 END)"


def bin_cte(src: str, name: str = "bins", n: int = N) -> str:
    cols = ", ".join([f"{_ok(i)} AS ok_{i}" for i in range(n)] + [f"{_late(i)} AS late_{i}" for i in range(n)])
    return f"{name} AS (SELECT *, {cols} FROM {src})"


def _sum(prefix: str, k: int) -> str:
    return "(" + " + ".join(f"{prefix}_{i}" for i in range(k)) + ")"


def share(prefix: str, k: int) -> str:
    return f"CAST(CAST({_sum(prefix, k)} AS DOUBLE) / {d(k)} AS FLOAT)"


def first_index(prefix: str, n: int = N) -> str:
    chain = " ".join(f"WHEN {prefix}_{i} = 1 THEN {i}" for i in range(n))
    return f"CAST(CASE {chain} END AS FLOAT)"


def trend(prefix: str = "ok", k: int = 6) -> str:
    xm = (k - 1) / 2.0
    denom = sum((i - xm) ** 2 for i in range(k))
    terms = " + ".join(f"CAST({prefix}_{i} AS DOUBLE) * {d(i - xm)}" for i in range(k))
    return f"CAST((CAST(0 AS DOUBLE) + {terms}) / {d(denom)} AS FLOAT)"


def switches(k: int, compat: bool = False) -> str:
    if compat:
        t = " + ".join(f"(CASE WHEN late_{i} - late_{i - 1} = 1 THEN 1 WHEN late_{i} - late_{i - 1} = -1 "
                       f"THEN 255 ELSE 0 END)" for i in range(1, k))
    else:
        t = " + ".join(f"ABS(late_{i} - late_{i - 1})" for i in range(1, k))
    return f"CAST(({t}) AS SMALLINT)"


def late_std(k: int) -> str:
    s = f"CAST({share('late', k)} AS DOUBLE)"
    return f"CAST(SQRT({s} * ({d(1.0)} - {s})) AS FLOAT)"


def any_late(k: int) -> str:
    return f"CAST(CASE WHEN {_sum('late', k)} > 0 THEN 1 ELSE 0 END AS TINYINT)"


def decay(dv: float, n: int = N, normalize: bool = False) -> str:
    w = [float(dv) ** i for i in range(n)]
    terms = " + ".join(f"late_{i} * {d(x)}" for i, x in enumerate(w))
    e = f"(CAST(0 AS DOUBLE) + {terms})"
    if normalize:
        e = f"{e} / {d(sum(w) + EPS)}"
    return f"CAST({e} AS FLOAT)"


def decay_name(dv: float) -> str:
    return "paym_late_time_decay_" + str(dv).replace(".", "")


def streak_ctes(src: str, kind: str, name: str, horizon: int = 24) -> str:
    """Longest run of 1s in the first ``horizon`` slots, via UNPIVOT and gaps-and-islands."""
    cols = ", ".join(f"{kind}_{i}" for i in range(horizon))
    return f"""{name}_long AS (
  SELECT id, rn, CAST(REPLACE(k, '{kind}_', '') AS INT) AS i, v
  FROM (UNPIVOT (SELECT id, rn, {cols} FROM {src}) ON {cols} INTO NAME k VALUE v)),
{name}_isl AS (
  SELECT id, rn, i - ROW_NUMBER() OVER (PARTITION BY id, rn ORDER BY i) AS g
  FROM {name}_long WHERE v = 1),
{name} AS (
  SELECT id, rn, MAX(c) AS longest FROM (SELECT id, rn, g, COUNT(*) AS c FROM {name}_isl GROUP BY id, rn, g)
  GROUP BY id, rn)"""


def seq_select(windows=WINDOWS, n: int = N) -> dict:
    """name -> expression of the sequence group over a bins relation (streaks joined separately)."""
    out = {}
    for k in windows:
        k = min(k, n)
        out[f"paym_ok_share_{k}"] = share("ok", k)
        out[f"paym_late_share_{k}"] = share("late", k)
    out["paym_last_late_recency"] = first_index("late", n)
    out["paym_last_ok_recency"] = first_index("ok", n)
    out["paym_ok_trend_6"] = trend("ok", min(6, n))
    return out


def transitions_select(windows=WINDOWS, n: int = N, single_decay: float = 0.85) -> dict:
    out = {}
    for k in windows:
        k = min(k, n)
        if k < 2:
            continue
        out[f"paym_transitions_{k}"] = switches(k)
        out[f"paym_late_std_{k}"] = late_std(k)
        out[f"paym_any_late_{k}"] = any_late(k)
    out["paym_late_time_decay"] = decay(single_decay, n)
    return out


# ---------------------------------------------------------------- ratio features
def per_abs(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / (ABS(CAST({den} AS DOUBLE)) + {d(EPS)}))"


TO_LIMIT = (("pre_loans_total_overdue", "overdue_to_limit"), ("pre_loans_max_overdue_sum", "maxover_to_limit"),
            ("pre_loans_outstanding", "outstanding_to_limit"), ("pre_loans_next_pay_summ", "nextpay_to_limit"))


def caps_ctes(src: str, name: str = "caps") -> str:
    """Raw limit ratios and their 1st / 99th percentiles (linear interpolation)."""
    raw = ", ".join(f"{per_abs(s, 'pre_loans_credit_limit')} AS r_{dst}" for s, dst in TO_LIMIT)
    q = ", ".join(f"quantile_cont(r_{dst}, {d(0.01)}) AS lo_{dst}, quantile_cont(r_{dst}, {d(0.99)}) AS hi_{dst}"
                  for _, dst in TO_LIMIT)
    return f"""{name}_raw AS (SELECT *, {raw} FROM {src}),
{name} AS (SELECT {q} FROM {name}_raw)"""


def capped(dst: str) -> str:
    return (f"CAST(CASE WHEN r_{dst} IS NULL THEN NULL ELSE LEAST(GREATEST(r_{dst}, lo_{dst}), hi_{dst}) END"
            f" AS FLOAT)")


def fl(c: str) -> str:
    return f"CAST({c} AS FLOAT)"


def flag(cond: str) -> str:
    return f"CAST(COALESCE({cond}, false) AS TINYINT)"


def ln1p(x: str) -> str:
    return f"CAST(CASE WHEN CAST({x} AS DOUBLE) > -1 THEN LN(1 + CAST({x} AS DOUBLE)) END AS FLOAT)"


def severity() -> str:
    pairs = (("pre_loans5", 1), ("pre_loans530", 2), ("pre_loans3060", 3), ("pre_loans6090", 4), ("pre_loans90", 5))
    t = " + ".join(f"CAST({c} AS DOUBLE) * {d(w)}" for c, w in pairs)
    return f"CAST(CAST(0 AS DOUBLE) + {t} AS FLOAT)"


def ratio_select() -> dict:
    """Row-level ratio/flag features that need only the capped limit ratios as columns."""
    out = {}
    out["overdue_ratio"] = fl(per_abs("pre_loans_total_overdue", "pre_loans_outstanding"))
    out["nextpay_ratio"] = fl(per_abs("pre_loans_next_pay_summ", "pre_loans_outstanding"))
    out["bucket_severity_score"] = severity()
    out["has_recent_90p"] = flag("CAST(pre_loans90 AS DOUBLE) > 0")
    out["util_x_overdue"] = "CAST(outstanding_to_limit AS FLOAT) * CAST(overdue_to_limit AS FLOAT)"
    out["util_x_outstanding"] = "CAST(outstanding_to_limit AS FLOAT) * CAST(outstanding_to_limit AS FLOAT)"
    zs = "(CAST(is_zero_loans3060 AS INT) + CAST(is_zero_loans6090 AS INT) + CAST(is_zero_loans90 AS INT))"
    out["zero_flags_sum"] = f"CAST({zs} AS SMALLINT)"
    out["zero_no_30plus_overdue"] = flag(f"{zs} = 3")
    out["util_log1p"] = ln1p("CAST(outstanding_to_limit AS FLOAT)")
    out["outstanding_log1p"] = ln1p("pre_loans_outstanding")
    out["total_overdue_log1p"] = ln1p("pre_loans_total_overdue")
    out["nextpay_log1p"] = ln1p("pre_loans_next_pay_summ")
    out["overdue_to_outstanding"] = fl(per_abs("pre_loans_total_overdue", "pre_loans_outstanding"))
    out["maxover_to_outstanding"] = fl(per_abs("pre_loans_max_overdue_sum", "pre_loans_outstanding"))
    out["credit_headroom"] = "CAST(1 AS FLOAT) - CAST(outstanding_to_limit AS FLOAT)"
    out["age_since_opened_minus_confirmed"] = f"{fl('pre_since_opened')} - {fl('pre_since_confirmed')}"
    return out


def v2_ctes(src: str, name: str = "v2", decays=(0.88, 0.95, 0.70), single_decay: float = 0.85,
            band_bins: int = 0, seq_only: bool = False) -> str:
    """Every v2 feature over ``src`` (which carries enc_paym_0..24 and the amount columns).

    ``seq_only`` keeps the history groups (sequence, transitions, momentum, decays).
    """
    seq = seq_select()
    tr = transitions_select(single_decay=single_decay)
    rat = ratio_select()
    seq_cols = ", ".join(f"{e} AS {k}" for k, e in {**seq, **tr}.items())
    lim_cols = ", ".join(f"{capped(dst)} AS {dst}" for _, dst in TO_LIMIT)
    multi = ", ".join(f"{decay(dv, normalize=True)} AS {decay_name(dv)}" for dv in decays)
    streaks = f"""{streak_ctes(name + '_b', 'ok', name + '_sok')},
{streak_ctes(name + '_b', 'late', name + '_slate')}"""
    joins = f"""LEFT JOIN {name}_sok so ON so.id = r.id AND so.rn = r.rn
  LEFT JOIN {name}_slate sl ON sl.id = r.id AND sl.rn = r.rn"""
    longest = """CAST(COALESCE(so.longest, 0) AS SMALLINT) AS paym_longest_ok_streak_24,
    CAST(COALESCE(sl.longest, 0) AS SMALLINT) AS paym_longest_late_streak_24"""
    if seq_only:
        s1 = f"""{bin_cte(src, name + '_b')},
{streaks},
{name}_s AS (
  SELECT r.*, {seq_cols}, {multi}, {longest}
  FROM {name}_b r {joins})"""
    else:
        s1 = f"""{bin_cte(src, name + '_b')},
{streaks},
{caps_ctes(name + '_b', name + '_caps')},
{name}_s AS (
  SELECT r.*, {seq_cols}, {multi}, {lim_cols}, {longest}
  FROM {name}_caps_raw r CROSS JOIN {name}_caps {joins})"""
    rat_cols = ", ".join(f"{e} AS {k}" for k, e in rat.items())
    deltas = (f"{fl('paym_ok_share_3')} - {fl('paym_ok_share_12')} AS paym_ok_share_delta_3_12, "
              f"{fl('paym_ok_share_6')} - {fl('paym_ok_share_12')} AS paym_ok_share_delta_6_12")
    mom = ", ".join(f"{fl(f'paym_late_share_{k}')} - {fl(f'paym_late_share_{max(2, k // 2)}')} AS paym_late_momentum_{k}"
                    for k in (6, 12, 24))
    flags = (f"{flag('CAST(paym_last_late_recency AS FLOAT) < 3')} AS flag_recently_late, "
             f"{flag('CAST(outstanding_to_limit AS FLOAT) > CAST(0.9 AS FLOAT) AND CAST(paym_late_share_6 AS FLOAT) > CAST(0.2 AS FLOAT)')} AS flag_high_util_recently, "
             f"{flag('CAST(paym_late_share_24 AS FLOAT) = CAST(0 AS FLOAT) AND CAST(outstanding_to_limit AS FLOAT) > CAST(0.8 AS FLOAT)')} AS flag_clean_but_high_util")
    grid = (f"{fl('paym_last_late_recency')} * {fl('pre_loans_total_overdue')} AS recency_x_total_overdue, "
            f"{fl('paym_late_share_6')} * {fl('outstanding_to_limit')} AS late6_x_util")
    drop_l = ["ok_" + str(i) for i in range(N)] + ["late_" + str(i) for i in range(N)]
    if not seq_only:
        drop_l += [f"r_{dst}" for _, dst in TO_LIMIT]
    drop = ", ".join(drop_l)
    if seq_only:
        s2 = f"""{name}_f AS (
  SELECT * EXCLUDE ({drop}), {deltas}, {mom} FROM {name}_s)"""
    else:
        s2 = f"""{name}_f AS (
  SELECT * EXCLUDE ({drop}), {rat_cols}, {deltas}, {mom}, {flags}, {grid} FROM {name}_s)"""
    if band_bins and band_bins > 1:
        probs = ", ".join(d(i / band_bins) for i in range(band_bins + 1))
        s3 = f"""{name}_u AS (
  SELECT *, CAST(CASE WHEN outstanding_to_limit IS NULL THEN NULL ELSE
    LEAST(GREATEST(CAST(outstanding_to_limit AS FLOAT), CAST(0 AS FLOAT)), CAST(5 AS FLOAT)) END AS DOUBLE) AS _u
  FROM {name}_f),
{name}_q AS (SELECT DISTINCT UNNEST(quantile_cont(_u, [{probs}])) AS e FROM {name}_u),
{name}_qi AS (SELECT e FROM {name}_q WHERE e > (SELECT MIN(e) FROM {name}_q) AND e < (SELECT MAX(e) FROM {name}_q)),
{name} AS (
  SELECT * EXCLUDE (_u), CAST(CASE WHEN _u IS NULL THEN NULL ELSE
    (SELECT COUNT(*) FROM {name}_qi WHERE {name}_qi.e < {name}_u._u) END AS SMALLINT) AS util_band_q{band_bins}
  FROM {name}_u)"""
    else:
        s3 = f"{name} AS (SELECT * FROM {name}_f)"
    return f"{s1},\n{s2},\n{s3}"


def v1_feature_ctes(src: str, name: str = "f1") -> str:
    """features_v1 (extended): shares, streaks, recency, trend, capped limit ratios, severity."""
    seq = seq_select()
    seq_cols = ", ".join(f"{e} AS {k}" for k, e in seq.items())
    lim_cols = ", ".join(f"{capped(dst)} AS {dst}" for _, dst in TO_LIMIT)
    drop = ", ".join(["ok_" + str(i) for i in range(N)] + ["late_" + str(i) for i in range(N)]
                     + [f"r_{dst}" for _, dst in TO_LIMIT])
    return f"""{bin_cte(src, name + '_b')},
{streak_ctes(name + '_b', 'ok', name + '_sok')},
{streak_ctes(name + '_b', 'late', name + '_slate')},
{caps_ctes(name + '_b', name + '_caps')},
{name} AS (
  SELECT r.* EXCLUDE ({drop}), {seq_cols}, {lim_cols},
    CAST(COALESCE(so.longest, 0) AS SMALLINT) AS paym_longest_ok_streak_24,
    CAST(COALESCE(sl.longest, 0) AS SMALLINT) AS paym_longest_late_streak_24,
    {severity()} AS bucket_severity_score,
    {flag('CAST(pre_loans90 AS DOUBLE) > 0')} AS has_recent_90p
  FROM {name}_caps_raw r CROSS JOIN {name}_caps
  LEFT JOIN {name}_sok so ON so.id = r.id AND so.rn = r.rn
  LEFT JOIN {name}_slate sl ON sl.id = r.id AND sl.rn = r.rn)"""


# The pruning rule (same as the library's).
KEEP_SET = ("paym_late_share_6", "paym_late_share_24", "paym_longest_late_streak_24",
            "paym_ok_trend_6", "paym_last_late_recency")
DROP_PREFIXES = ("paym_late_share_", "paym_longest_", "paym_ok_trend_", "paym_last_")


def pruned(columns, drop_util_x_overdue: bool) -> list:
    drop = {c for c in columns if c.startswith("paym_ok_share_")}
    drop |= {c for c in columns if c.startswith(DROP_PREFIXES) and c not in KEEP_SET}
    drop.add("paym_last_status")
    if drop_util_x_overdue:
        drop.add("util_x_overdue")
    drop |= {f"enc_paym_{i}" for i in range(3, N)}
    return [c for c in columns if c not in drop]


# ---------------------------------------------------------------- output rounding
FLOAT_PREFIXES = ("paym_ok_share_", "paym_late_share_", "paym_late_std_", "paym_late_time_decay",
                  "paym_late_momentum_", "paym_last_", "paym_ok_trend_")
FLOAT_NAMES = {"overdue_to_limit", "maxover_to_limit", "outstanding_to_limit", "nextpay_to_limit", "overdue_ratio",
               "nextpay_ratio", "bucket_severity_score", "util_x_overdue", "util_x_outstanding", "util_log1p",
               "outstanding_log1p", "total_overdue_log1p", "nextpay_log1p", "overdue_to_outstanding",
               "maxover_to_outstanding", "credit_headroom", "age_since_opened_minus_confirmed",
               "recency_x_total_overdue", "late6_x_util", "paym_ok_share_delta_3_12", "paym_ok_share_delta_6_12"}


def is_float(name: str) -> bool:
    return name in FLOAT_NAMES or name.startswith(FLOAT_PREFIXES)


def finish(rel: str, cols, extra_float=()) -> str:
    """SELECT of ``cols`` from ``rel`` with float columns rounded to 6 decimals as DOUBLE."""
    fl_ = set(extra_float)
    parts = []
    for c in cols:
        parts.append(rnd(c, c) if (is_float(c) or c in fl_) else c)
    return f"SELECT {', '.join(parts)} FROM {rel}"
