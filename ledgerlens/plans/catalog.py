"""Registered queries: every operator run over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Inputs are the
domain fixtures derived from the TPC-H-like tables (see ``sources.fixtures``),
so the work of every query grows with the tables.  Float and double outputs
are rounded to 6 decimals (as DOUBLE) so independent engines can be compared
value by value.
"""

from __future__ import annotations

import os
import uuid
from typing import Callable, Dict

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ledgerlens.config import FeatureConfigExtendedV2
from ledgerlens.functions import sequence as S
from ledgerlens.operators import aligned as AL
from ledgerlens.operators import assemble as A
from ledgerlens.operators import metrics as M
from ledgerlens.operators import profile as P
from ledgerlens.operators import profile_store as PS
from ledgerlens.operators import sampling as SM
from ledgerlens.operators import schema as SC
from ledgerlens.operators import sparse_categories as SP
from ledgerlens.operators.quantiles import percentile_caps
from ledgerlens.plans import datasets as D
from ledgerlens.plans import modeling as ML
from ledgerlens.plans.features import WHY, features_base, features_v1, features_v2
from ledgerlens.session import materialize, scratch_dir
from ledgerlens.sources import fixtures as FX
from ledgerlens.sources import io as IO
from ledgerlens.sources import widening as WD
from ledgerlens.streaming.assembly import assemble_stream, read_assembled
from ledgerlens.streaming.incremental import row_fn
from ledgerlens.streaming.shards import map_shards

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: Dict[str, Query] = {}
TIE = ["o_orderkey"]


def q(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def finish(df: DataFrame) -> DataFrame:
    """Floats/doubles -> DOUBLE rounded to 6 decimals (other columns untouched)."""
    fix = {f.name: F.round(F.col(f.name).cast("double"), 6) for f in df.schema.fields
           if isinstance(f.dataType, (FloatType, DoubleType))}
    return df.withColumns(fix) if fix else df


def tbl(spark, sf, name):
    return FX.table(spark, sf, name)


_MEMO: Dict[tuple, DataFrame] = {}


def _memo(spark, sf, name, build):
    """One derivation of a written intermediate per session and scale factor."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf), name)
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def cp(spark, sf):
    """Product rows (the history numbering writes its range slices once per session)."""
    return _memo(spark, sf, "cp", lambda: FX.credit_products(spark, sf))


def labels(spark, sf):
    return FX.labels_credit(spark, sf)


def latest(spark, sf):
    return A.latest_record(cp(spark, sf), tiebreak=TIE)


def latest_m(spark, sf):
    """Latest records written once to the checkpoint folder (inputs of multi-pass plans)."""
    return _memo(spark, sf, "latest", lambda: materialize(latest(spark, sf)))


def v1(spark, sf):
    return _memo(spark, sf, "v1", lambda: D.dataset_v1(cp(spark, sf), labels(spark, sf), tiebreak=TIE))


def scored_rows(spark, sf):
    return FX.scored(spark, sf, cp(spark, sf))


def run_path(spark, name: str) -> str:
    return os.path.join(scratch_dir(spark, "runs"), f"{name}-{uuid.uuid4().hex[:12]}")


NUM_LI = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax"]
SEQ_ONLY = FeatureConfigExtendedV2(use_ratios=False, use_outstanding_ratios=False, use_bucket_severity=False,
                                   use_interactions=False, use_zero_aggregates=False, use_logs=False,
                                   use_cross_ratios=False, use_behavioral_flags=False, use_age_exposure=False,
                                   use_interaction_grid=False)


def seq_features(spark, sf) -> DataFrame:
    return features_v2(cp(spark, sf), SEQ_ONLY)


def all_features(spark, sf) -> DataFrame:
    return features_v2(materialize(cp(spark, sf)))


def keyed(df: DataFrame, *cols: str) -> DataFrame:
    return finish(df.select("id", "rn", *cols))


# ================================================================ 2.1 sources / sinks
@q("scan_parquet")
def scan_parquet(spark, sf):
    return finish(IO.scan_parquet(spark, os.path.join(sf, "lineitem.parquet"),
                                  ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice"]))


@q("scan_sample_head")
def scan_sample_head(spark, sf):
    return finish(IO.scan_sample_head(spark, os.path.join(sf, "orders.parquet"), 1000, ["o_orderkey"],
                                      ["o_orderkey", "o_custkey", "o_totalprice"]))


def write_shards(spark, sf, drop_upper: bool = True, one_file: bool = False) -> str:
    """Product rows as 12 shard folders (o_orderkey % 12); shards 6..11 lack one column."""
    root = run_path(spark, "shards")
    rows = cp(spark, sf).withColumn("shard", (F.col("o_orderkey") % 12).cast("int"))
    if one_file:
        rows = rows.repartition("shard")
    if not drop_upper:                               # one schema, one pass over the products
        IO.sink_parquet(rows, root, mode="append", partition_by=["shard"])
        return root
    lo, hi = rows.filter(F.col("shard") < 6), rows.filter(F.col("shard") >= 6)
    IO.sink_parquet(lo, root, mode="append", partition_by=["shard"])
    IO.sink_parquet(hi.drop("pre_loans_next_pay_summ"), root, mode="append", partition_by=["shard"])
    return root


@q("scan_shards")
def scan_shards(spark, sf):
    df = IO.scan_shards(spark, write_shards(spark, sf))
    return df.select("id", "rn", "o_orderkey", "pre_loans_next_pay_summ", "shard")


@q("scan_widened")
def scan_widened(spark, sf):
    """Shards that disagree on types: counts as int and bigint, amounts as int and double, codes as int and text."""
    root = run_path(spark, "mixed")
    c = cp(spark, sf).select("id", "rn", "o_orderkey", "pre_loans_outstanding", "enc_loans_credit_type", "pre_loans5")
    parts = [c.drop("pre_loans5"), c.withColumns({"rn": F.col("rn").cast("long"), "pre_loans_outstanding": F.col("pre_loans_outstanding") / 4}),
             c.withColumn("enc_loans_credit_type", F.concat(F.lit("t"), F.col("enc_loans_credit_type")))]
    for k, part in enumerate(parts):
        part.where(F.col("o_orderkey") % 3 == k).write.mode("append").parquet(root)
    return finish(WD.scan_widened(spark, root).drop("source_file"))


def write_labels_csv(spark, sf, name="labels") -> str:
    path = run_path(spark, name) + ".csv"
    IO.sink_csv(labels(spark, sf), path)
    return path


@q("scan_csv_labels")
def scan_csv_labels(spark, sf):
    return IO.scan_csv_labels(spark, write_labels_csv(spark, sf))


@q("scan_by_suffix")
def scan_by_suffix(spark, sf):
    return IO.scan_by_suffix(spark, write_labels_csv(spark, sf), csv_schema="id string, flag int")


@q("shard_inventory")
def shard_inventory(spark, sf):
    return IO.shard_inventory(spark, write_shards(spark, sf))


SHARD_EXPECTED = ["pre_loans_outstanding", "pre_loans_next_pay_summ", "pre_since_confirmed", "enc_paym_1",
                  "enc_paym_24"]


@q("shard_profile")
def shard_profile(spark, sf):
    df = IO.scan_shards(spark, write_shards(spark, sf))
    return finish(IO.shard_profile(df, SHARD_EXPECTED, "shard"))


@q("sink_parquet")
def sink_parquet(spark, sf):
    path = IO.sink_parquet(FX.paym_events(spark, sf), run_path(spark, "paym_events"))
    return spark.read.parquet(path)


@q("sink_csv")
def sink_csv(spark, sf):
    path = IO.sink_csv(scored_rows(spark, sf), run_path(spark, "scored"))
    return finish(spark.read.schema("id string, rn int, target int, pred_proba double")
                  .option("header", True).csv(path))


@q("sink_json_report")
def sink_json_report(spark, sf):
    rep = M.evaluate_binary(scored_rows(spark, sf), name="score_ratio")
    path = IO.sink_json_report(spark, rep, run_path(spark, "report"))
    return finish(spark.read.schema("name string, roc_auc double, auc_pr double, best_f1 double, "
                                    "best_threshold double, n_samples long").json(path))


# ================================================================ 2.2 schema
@q("normalize_id")
def normalize_id(spark, sf):
    return SC.normalize_id(tbl(spark, sf, "events").select("event_id", "user_id")).select("id", "event_id")


@q("harmonize_dtypes")
def harmonize_dtypes(spark, sf):
    return SC.harmonize_dtypes(cp(spark, sf))


@q("sanitize_dtypes")
def sanitize_dtypes(spark, sf):
    return SC.sanitize_dtypes(cp(spark, sf))


@q("downcast_numeric")
def downcast_numeric(spark, sf):
    return finish(SC.downcast_numeric(tbl(spark, sf, "lineitem").select(*NUM_LI), skip=()))


@q("add_nan_flags")
def add_nan_flags(spark, sf):
    return SC.add_nan_flags(cp(spark, sf))


@q("cleanup_base")
def cleanup_base(spark, sf):
    return finish(SC.cleanup_base(features_base(latest(spark, sf))))


@q("cleanup_ext")
def cleanup_ext(spark, sf):
    li = tbl(spark, sf, "lineitem")
    df = li.select("l_orderkey", "l_linenumber",
                   F.when(F.col("l_discount") == 0, F.lit(float("inf")))
                   .otherwise(F.col("l_quantity") / F.col("l_discount")).alias("qty_per_discount"),
                   F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(F.col("l_tax")).alias("tax"))
    return finish(SC.cleanup_floats(df))


@q("impute_sentinel")
def impute_sentinel(spark, sf):
    return keyed(SC.impute_sentinel(features_v1(latest_m(spark, sf))),
                 "paym_last_late_recency", "paym_last_ok_recency")


@q("one_hot")
def one_hot(spark, sf):
    out = SC.one_hot(cp(spark, sf), ["enc_loans_credit_type", "enc_loans_credit_status"])
    return out.select("id", "rn", *[c for c in out.columns if c.startswith("OHE_")])


@q("one_hot_sparse")
def one_hot_sparse(spark, sf):
    """Every customer key a category: the slots that an order's sparse vector holds, read from its indices."""
    orders = tbl(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    cats = SP.fit_categories(orders.where("o_orderkey % 3 > 0"), ["o_custkey", "o_orderpriority"])
    return SP.one_hot_sparse(orders, cats).select(
        "o_orderkey", F.array_join(SP.slots("one_hot").cast("array<string>"), ",").alias("slots"))


@q("prune_features")
def prune_features(spark, sf):
    return finish(SC.prune_features(SC.impute_sentinel(features_v2(latest_m(spark, sf)))))


TRIAL_GROUPS = [["pre_loans_credit_limit", "pre_loans_outstanding"], ["enc_paym_0", "enc_paym_1", "enc_paym_2"],
                ["is_zero_loans90", "pre_loans90", "pre_loans_outstanding"]]


@q("trial_frame")
def trial_frame(spark, sf):
    return SC.trial_frame(cp(spark, sf), TRIAL_GROUPS)


@q("split_columns")
def split_columns(spark, sf):
    return SC.split_columns(cp(spark, sf)).select("column", "kind", "is_binary")


@q("filter_labelled")
def filter_labelled(spark, sf):
    return A.filter_labelled(v1(spark, sf)).select("id", "rn", "target")


@q("filter_equals_latest")
def filter_equals_latest(spark, sf):
    return A.filter_equals_latest(cp(spark, sf), order="rn_dup").select("id", "rn", "rn_dup", "o_orderkey")


# ================================================================ 2.3 joins
@q("join_labels_left")
def join_labels_left(spark, sf):
    return A.join_labels_left(latest(spark, sf).select("id", "rn", "o_orderkey"), labels(spark, sf))


@q("join_latest_semi")
def join_latest_semi(spark, sf):
    return A.filter_equals_latest(cp(spark, sf), order="rn").select("id", "rn", "o_orderkey")


PAYM_FEATS = (["paym_ok_share_3", "paym_late_share_3", "paym_ok_share_6", "paym_late_share_6", "paym_ok_share_12",
               "paym_late_share_12", "paym_ok_share_24", "paym_late_share_24", "paym_longest_ok_streak_24",
               "paym_longest_late_streak_24", "paym_last_late_recency", "paym_last_ok_recency", "paym_ok_trend_6"]
              + [f"paym_{x}_{k}" for k in (3, 6, 12, 24) for x in ("transitions", "late_std", "any_late")]
              + ["paym_late_time_decay", "paym_ok_share_delta_3_12", "paym_ok_share_delta_6_12",
                 "paym_late_momentum_6", "paym_late_momentum_12", "paym_late_momentum_24",
                 "paym_late_time_decay_088", "paym_late_time_decay_095", "paym_late_time_decay_07"])


@q("join_paym_aligned")
def join_paym_aligned(spark, sf):
    """Dense event histories: the features read the history columns of the same row."""
    return keyed(features_v2(FX.paym_events(spark, sf), SEQ_ONLY), *PAYM_FEATS)


@q("join_paym_history")
def join_paym_history(spark, sf):
    """The histories as a stored table of their own, joined by (id, rn) without moving them."""
    events = materialize(FX.paym_events(spark, sf))
    name = f"history_{uuid.uuid4().hex[:12]}"
    AL.store_history(events, name, run_path(spark, "history"))
    return keyed(features_v2(AL.join_history(events.select("id", "rn"), name), SEQ_ONLY), *PAYM_FEATS)


@q("label_gap")
def label_gap(spark, sf):
    return A.label_gap(cp(spark, sf), labels(spark, sf))


# ================================================================ 2.4 aggregation / profiling
@q("agg_max_by_id")
def agg_max_by_id(spark, sf):
    return A.max_rn_by_id(cp(spark, sf))


@q("prof_basic")
def prof_basic(spark, sf):
    return finish(P.prof_basic(tbl(spark, sf, "lineitem")).drop("dtype"))


@q("profile_rollup")
def profile_rollup(spark, sf):
    """Profiles of twelve shards, stored in two steps, rolled up without reading a shard again (exact parts)."""
    shards, store = write_shards(spark, sf, one_file=True), run_path(spark, "profiles")
    PS.add_profiles(spark, os.path.join(shards, "shard=3"), store)
    PS.add_profiles(spark, shards, store)
    return finish(PS.roll_up(spark, shards, store).drop("n_unique"))


@q("prof_numeric")
def prof_numeric(spark, sf):
    return finish(P.prof_numeric(tbl(spark, sf, "lineitem"), NUM_LI))


@q("prof_categorical")
def prof_categorical(spark, sf):
    return P.prof_categorical(tbl(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], top_k=5)


@q("prof_missing_top")
def prof_missing_top(spark, sf):
    return finish(P.prof_missing_top(cp(spark, sf), 25))


@q("feature_catalogue")
def feature_catalogue(spark, sf):
    return finish(P.feature_catalogue(materialize(features_v2(latest_m(spark, sf))), WHY))


@q("feature_catalogue_stats")
def feature_catalogue_stats(spark, sf):
    """The catalogue's null rates and distinct counts (logarithms aside, whose last bit is the platform's)."""
    full = P.feature_catalogue(materialize(features_v2(latest_m(spark, sf))), WHY)
    return finish(full.where(~F.col("column").endswith("_log1p")).select("column", "null_rate", "n_unique"))


@q("eda_summary")
def eda_summary(spark, sf):
    """File inventory + column classes + top missing, as one row."""
    inv = IO.shard_inventory(spark, write_shards(spark, sf))
    cls = SC.split_columns(cp(spark, sf)).groupBy().pivot("kind", ["numeric", "categorical"]).count()
    bins = SC.split_columns(cp(spark, sf)).agg(F.sum(F.col("is_binary").cast("int")).alias("binary"))
    top = P.prof_missing_top(cp(spark, sf), 20).agg(
        F.to_json(F.collect_list(F.struct("column", "null_rate"))).alias("missing_top20"))
    rows = cp(spark, sf).agg(F.count(F.lit(1)).alias("rows"), F.lit(len(cp(spark, sf).columns)).alias("cols"))
    return P._one_row(inv, cls, bins, top, rows)


HIST_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@q("hist_equal_width")
def hist_equal_width(spark, sf):
    return finish(P.hist_equal_width(tbl(spark, sf, "lineitem"), HIST_COLS, 50))


@q("corr_matrix")
def corr_matrix(spark, sf):
    return finish(P.corr_matrix(tbl(spark, sf, "lineitem"), NUM_LI))


@q("corr_top_pairs")
def corr_top_pairs(spark, sf):
    c = materialize(cp(spark, sf))
    return finish(P.corr_top_pairs(c, 30, 0.98, P.numeric_cols(c)))


@q("corr_with_target")
def corr_with_target(spark, sf):
    return finish(P.corr_with_target(materialize(v1(spark, sf)), "target", 20))


@q("identical_columns")
def identical_columns(spark, sf):
    return P.identical_columns(materialize(features_v2(latest_m(spark, sf))))


@q("qc_postcheck")
def qc_postcheck(spark, sf):
    return finish(P.qc_postcheck(v1(spark, sf)))


@q("qc_labels")
def qc_labels(spark, sf):
    return finish(P.qc_labels(v1(spark, sf), labels(spark, sf)))


@q("qc_cardinality")
def qc_cardinality(spark, sf):
    return finish(P.qc_cardinality(cp(spark, sf), labels(spark, sf)))


@q("pos_rate")
def pos_rate(spark, sf):
    return finish(P.pos_rate(v1(spark, sf)))


@q("percentile_caps")
def percentile_caps_q(spark, sf):
    lt = latest_m(spark, sf)
    ratios = {dst: F.col(src).cast("double") / (F.abs(F.col("pre_loans_credit_limit").cast("double")) + F.lit(1e-4))
              for src, dst in (("pre_loans_total_overdue", "overdue_to_limit"),
                               ("pre_loans_max_overdue_sum", "maxover_to_limit"),
                               ("pre_loans_outstanding", "outstanding_to_limit"),
                               ("pre_loans_next_pay_summ", "nextpay_to_limit"))}
    probe = lt.select(*[e.alias(k) for k, e in ratios.items()])
    caps = percentile_caps(probe, list(ratios))
    return finish(spark.createDataFrame([(k, lo, hi) for k, (lo, hi) in caps.items()],
                                        "column string, lo double, hi double"))


# ================================================================ 2.5 windows / sorts / sampling
@q("latest_record")
def latest_record(spark, sf):
    return latest(spark, sf)


@q("dedupe_keep_last")
def dedupe_keep_last(spark, sf):
    return A.dedupe_keep_last(cp(spark, sf), keys=("id", "rn_dup"), tiebreak=TIE)


@q("sort_topk")
def sort_topk(spark, sf):
    return latest(spark, sf).orderBy(F.desc("pre_loans_outstanding"), "id").limit(20) \
        .select("id", "rn", "pre_loans_outstanding")


@q("util_band")
def util_band(spark, sf):
    return keyed(features_v2(latest_m(spark, sf), FeatureConfigExtendedV2(risk_band_bins=10)), "util_band_q10")


@q("sample_n")
def sample_n(spark, sf):
    return SM.sample_n(cp(spark, sf), 500, seed=42).select("id", "rn", "o_orderkey")


@q("stratified_split")
def stratified_split(spark, sf):
    lab = A.filter_labelled(v1(spark, sf))
    return SM.stratified_split(lab, 0.2, 42, "target").select("id", "rn", "target", "is_valid")


# ================================================================ 2.6 set operations
@q("union_shards")
def union_shards(spark, sf):
    c = cp(spark, sf)
    even = c.filter(F.col("o_orderkey") % 2 == 0)
    odd = c.filter(F.col("o_orderkey") % 2 == 1).drop("pre_loans_next_pay_summ")
    return A.union_shards([even, odd])


@q("intersect_ids")
def intersect_ids(spark, sf):
    return A.intersect_ids(cp(spark, sf), labels(spark, sf))


def diff_versions(spark, sf):
    a = cp(spark, sf)
    b = (a.filter(F.col("o_orderkey") % 10 != 0)
         .drop(*[f"enc_paym_{i}" for i in range(20, 25)])
         .withColumn("extra", F.col("rn") * 2)
         .withColumn("pre_loans_outstanding",
                     F.when(F.col("rn") == 1, F.col("pre_loans_outstanding") + 1)
                     .otherwise(F.col("pre_loans_outstanding"))))
    return a, b


@q("dataset_diff")
def dataset_diff(spark, sf):
    a, b = diff_versions(spark, sf)
    return A.dataset_diff(a, b, keys=("id", "rn"))


# ================================================================ 2.7 sequence features
@q("paym_binarize")
def paym_binarize(spark, sf):
    c = cp(spark, sf)
    arr = S.paym_array(S.order_paym_cols(c.columns))
    digits = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), "")
    return c.select("id", "rn", digits(S.binarize(arr, (0, 1))).alias("ok_bits"),
                    digits(S.binarize(arr, (2, 3, 4, 5, 6, 7, 8, 9))).alias("late_bits"))


@q("paym_last_status")
def paym_last_status(spark, sf):
    return keyed(features_base(cp(spark, sf)), "paym_last_status")


@q("paym_last_clean_streak")
def paym_last_clean_streak(spark, sf):
    return keyed(features_base(cp(spark, sf)), "paym_last_clean_streak")


def _seq_q(name, cols):
    @q(name)
    def run(spark, sf):
        return keyed(seq_features(spark, sf), *cols)
    run.__name__ = name
    return run


_seq_q("paym_share", [f"paym_{x}_share_{k}" for k in (3, 6, 12, 24) for x in ("ok", "late")])
_seq_q("paym_longest_streak", ["paym_longest_ok_streak_24", "paym_longest_late_streak_24"])
_seq_q("paym_recency", ["paym_last_late_recency", "paym_last_ok_recency"])
_seq_q("paym_trend", ["paym_ok_trend_6"])
_seq_q("paym_late_std", [f"paym_late_std_{k}" for k in (3, 6, 12, 24)])
_seq_q("paym_any_late", [f"paym_any_late_{k}" for k in (3, 6, 12, 24)])
_seq_q("paym_time_decay", ["paym_late_time_decay"])
_seq_q("paym_time_decay_multi", ["paym_late_time_decay_088", "paym_late_time_decay_095", "paym_late_time_decay_07"])
_seq_q("paym_share_delta", ["paym_ok_share_delta_3_12", "paym_ok_share_delta_6_12"])
_seq_q("paym_momentum", ["paym_late_momentum_6", "paym_late_momentum_12", "paym_late_momentum_24"])


@q("paym_transitions")
def paym_transitions(spark, sf):
    """Both counts from one set of slot columns, in one projection."""
    rows = cp(spark, sf)
    slots = S.slot_flags(S.order_paym_cols(rows.columns, SEQ_ONLY.paym_cols), SEQ_ONLY.paym_ok_values,
                         SEQ_ONLY.paym_late_values)
    return rows.withColumns(slots).select(
        "id", "rn", *[S.switches(S.LATE_PREFIX, k).alias(f"paym_transitions_{k}") for k in (3, 6, 12, 24)],
        S.switches(S.LATE_PREFIX, 24, compat_uint8=True).alias("paym_transitions_compat_24"))


# ================================================================ 2.8 row-local math / flags
def _feat_q(name, cols):
    @q(name)
    def run(spark, sf):
        return keyed(all_features(spark, sf), *cols)
    run.__name__ = name
    return run


_feat_q("ratio_to_limit", ["overdue_to_limit", "maxover_to_limit", "outstanding_to_limit", "nextpay_to_limit"])
_feat_q("ratio_to_outstanding", ["overdue_ratio", "nextpay_ratio"])
_feat_q("cross_ratios", ["overdue_to_outstanding", "maxover_to_outstanding", "credit_headroom"])
_feat_q("bucket_severity", ["bucket_severity_score"])
_feat_q("has_recent_90p", ["has_recent_90p"])
_feat_q("util_interactions", ["util_x_overdue", "util_x_outstanding"])
_feat_q("interaction_grid", ["recency_x_total_overdue", "late6_x_util"])
_feat_q("log1p_features", ["util_log1p", "outstanding_log1p", "total_overdue_log1p", "nextpay_log1p"])
_feat_q("behavioral_flags", ["flag_recently_late", "flag_high_util_recently", "flag_clean_but_high_util"])
_feat_q("age_exposure", ["age_since_opened_minus_confirmed"])
_feat_q("zero_flag_aggs", ["zero_flags_sum", "zero_no_30plus_overdue"])


@q("features_base")
def features_base_q(spark, sf):
    return finish(features_base(latest(spark, sf)))


@q("features_v1")
def features_v1_q(spark, sf):
    return finish(features_v1(latest_m(spark, sf)))


@q("features_v2")
def features_v2_q(spark, sf):
    return finish(features_v2(latest_m(spark, sf)))


@q("features_v2_windows")
def features_v2_windows(spark, sf):
    """Windows without 6: momentum makes that share, and the flags and interactions that read it stay."""
    return finish(features_v2(latest_m(spark, sf), FeatureConfigExtendedV2(windows=(3, 12, 24))))


@q("dataset_v1")
def dataset_v1(spark, sf):
    return finish(v1(spark, sf))


@q("dataset_v2")
def dataset_v2(spark, sf):
    return finish(D.dataset_v2(v1(spark, sf)))


@q("dataset_v3")
def dataset_v3(spark, sf):
    return finish(D.dataset_v3(v1(spark, sf)))


# ================================================================ 2.9 modeling
@q("balanced_weights")
def balanced_weights(spark, sf):
    lab = A.filter_labelled(v1(spark, sf)).select("id", "rn", "target")
    return finish(SM.balanced_weights(lab, "target", "weight"))


IMPUTE_COLS = ["pre_loans_outstanding", "pre_since_confirmed", "enc_paym_12", "enc_paym_24"]
SCALE_COLS = ["pre_loans_credit_limit", "pre_loans_outstanding", "pre_loans5", "is_zero_loans90"]


@q("impute_median")
def impute_median(spark, sf):
    return keyed(ML.impute_median(latest_m(spark, sf), IMPUTE_COLS), *IMPUTE_COLS)


@q("scale_no_center")
def scale_no_center(spark, sf):
    return keyed(ML.scale_no_center(latest_m(spark, sf), SCALE_COLS), *SCALE_COLS)


def v3(spark, sf):
    """dataset v3, written once to the shared checkpoint folder per session."""
    return _memo(spark, sf, "v3", lambda: materialize(D.dataset_v3(v1(spark, sf))))


def v3_split(spark, sf):
    """dataset v3 with a stratified 80/20 split (every model query of the session reuses it)."""
    return _memo(spark, sf, "v3_split", lambda: materialize(ML.split_frame(v3(spark, sf), 0.2, 42)))


def _train_valid(spark, sf):
    sp = v3_split(spark, sf)
    return sp.filter(~F.col("is_valid")).drop("is_valid"), sp.filter(F.col("is_valid")).drop("is_valid")


@q("fit_logreg")
def fit_logreg(spark, sf):
    tr, va = _train_valid(spark, sf)
    return finish(ML.evaluate_model(ML.fit_logreg(tr), va, "logreg"))


@q("fit_rf")
def fit_rf(spark, sf):
    tr, va = _train_valid(spark, sf)
    return finish(ML.evaluate_model(ML.fit_rf(tr), va, "random_forest"))


BOOST_ROUNDS = 5000      # the original's limit; early stopping ends before it


@q("fit_gbt")
def fit_gbt(spark, sf):
    sp = v3_split(spark, sf)
    m = ML.fit_gbt(sp, ML.feature_columns(sp), max_iter=BOOST_ROUNDS, valid_col="is_valid")
    return finish(ML.evaluate_model(m, sp.filter(F.col("is_valid")).drop("is_valid"), "gbt"))


@q("random_search_cv")
def random_search_cv(spark, sf):
    tr, _ = _train_valid(spark, sf)
    return finish(ML.random_search_cv(tr, n_iter=30, n_folds=4, max_iter=BOOST_ROUNDS))


@q("metric_roc_auc")
def metric_roc_auc(spark, sf):
    return finish(M.roc_auc(scored_rows(spark, sf)))


@q("metric_avg_precision")
def metric_avg_precision(spark, sf):
    return finish(M.average_precision(scored_rows(spark, sf)))


@q("metric_best_f1")
def metric_best_f1(spark, sf):
    return finish(M.best_f1(scored_rows(spark, sf)))


@q("roc_curve")
def roc_curve(spark, sf):
    return finish(M.roc_curve(scored_rows(spark, sf)))


@q("pr_curve")
def pr_curve(spark, sf):
    return finish(M.pr_curve(scored_rows(spark, sf)))


@q("youden_threshold")
def youden_threshold(spark, sf):
    return finish(M.youden_threshold(scored_rows(spark, sf)))


@q("evaluate_binary")
def evaluate_binary(spark, sf):
    return finish(M.evaluate_binary(scored_rows(spark, sf), name="score_ratio"))


@q("feature_importance_topk")
def feature_importance_topk(spark, sf):
    tr, _ = _train_valid(spark, sf)
    feats = ML.feature_columns(tr)
    return finish(ML.feature_importance_topk(ML.fit_rf(tr, feats, n_trees=100, max_depth=10), feats, 20))


@q("permutation_importance")
def permutation_importance(spark, sf):
    tr, va = _train_valid(spark, sf)
    m = ML.fit_rf(tr, n_trees=100, max_depth=10)
    return finish(ML.permutation_importance(m, va, n_repeats=5))


# groups of features by their names
ABLATION_PATTERNS = {
    "payment_seq": r"^paym_(?!last_status)",
    "ratios": r"_to_(limit|outstanding)$|_ratio$|^credit_headroom$",
    "severity": r"^bucket_severity|^has_recent_90p$|^pre_loans\d+$",
    "raw_history": r"^enc_paym_\d+$",
}


@q("group_ablation")
def group_ablation(spark, sf):
    sp = v3_split(spark, sf).drop("is_valid")
    return finish(ML.group_ablation(sp, ML.match_groups(ML.feature_columns(sp), ABLATION_PATTERNS)))


@q("predict_batch")
def predict_batch(spark, sf):
    tr, _ = _train_valid(spark, sf)
    m = ML.fit_logreg(tr)
    return finish(ML.predict_batch(m, v3(spark, sf)))


@q("inference_job")
def inference_job(spark, sf):
    tr, _ = _train_valid(spark, sf)
    model_path = ML.model_persist(ML.fit_logreg(tr), run_path(spark, "model"))
    inp = IO.sink_parquet(v3(spark, sf), run_path(spark, "v3") + ".parquet")
    out = ML.inference_job(spark, inp, run_path(spark, "pred") + ".csv", model_path)
    return finish(spark.read.schema("id string, rn int, pred_proba double").option("header", True).csv(out))


@q("model_persist")
def model_persist(spark, sf):
    tr, va = _train_valid(spark, sf)
    path = ML.persist_run(ML.fit_logreg(tr), run_path(spark, "model"), tr, va, "logreg", {"C": 1.0, "l1_ratio": 0.5}, seed=42)
    meta = ML.read_metadata(spark, path)
    ev = ML.evaluate_model(ML.load_model(path), va, meta["model"])
    return finish(ev.withColumns({"n_features": F.lit(len(meta["features"])), "n_train": F.lit(meta["n_train"]).cast("long"),
                                  "same_auc": F.abs(F.col("roc_auc") - F.lit(meta["roc_auc"])) < 1e-9}))


# ================================================================ 2.10 streaming / UDF surface
@q("incremental_assembly")
def incremental_assembly_q(spark, sf):
    """Twelve shard files in micro-batches of four -> dataset_v1 with the loop's counters."""
    shards = write_shards(spark, sf, drop_upper=False, one_file=True)
    schema = spark.read.parquet(shards).drop("shard").schema
    out = run_path(spark, "assembled")
    done = assemble_stream(spark, shards, out, run_path(spark, "stream_ckpt"), schema, materialize(labels(spark, sf)),
                           tiebreak=TIE)
    return finish(read_assembled(spark, out, done)).withColumns(
        {n: F.lit(getattr(done, n)).cast("long") for n in ("written", "matched", "batches")})


def _util_pd(pdf: pd.DataFrame) -> pd.DataFrame:
    out = pdf[["id", "rn"]].copy()
    out["util_pd"] = pdf["pre_loans_outstanding"].astype("float64") / pdf["pre_loans_credit_limit"].astype("float64")
    return out


@q("row_fn")
def row_fn_q(spark, sf):
    src = cp(spark, sf).select("id", "rn", "pre_loans_outstanding", "pre_loans_credit_limit")
    return finish(row_fn(src, _util_pd, "id string, rn int, util_pd double"))


def _place_in_shard(pdf: pd.DataFrame) -> pd.DataFrame:
    out = pdf.sort_values("o_orderkey")[["id", "rn", "o_orderkey"]]
    return out.assign(place=range(1, len(out) + 1))


@q("row_fn_shards")
def row_fn_shards(spark, sf):
    """A callback that sorts its whole shard."""
    shards = write_shards(spark, sf, one_file=True)
    return map_shards(spark, shards, _place_in_shard, "id string, rn int, o_orderkey long, place long", ["id", "rn", "o_orderkey"])
