"""Model data preparation, training, evaluation, scoring and persistence with Spark ML.

The fitted preparation (exact medians, population standard deviations) is
baked into the saved ``PipelineModel`` as a ``SQLTransformer`` plus an
``ElementwiseProduct``, so training and batch scoring share one ``prepare``
stage.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from typing import Dict, List, Optional, Sequence

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.cumulative import global_index
from ledgerlens.operators.metrics import evaluate_binary, roc_auc_by
from ledgerlens.operators.profile import numeric_cols
from ledgerlens.operators.quantiles import quantile_table
from ledgerlens.operators.sampling import balanced_weights, row_hash_key, stratified_split, unit_hash
from ledgerlens.plans.boosting import fit_with_patience
from ledgerlens.plans.forest import ForestModel, coded, fit_coded, fit_forest
from ledgerlens.plans.permuted import codes_of, permuted_auc
from ledgerlens.plans.search import ROWS_A_TASK, random_search_cv, refit_best  # noqa: F401
from ledgerlens.session import materialize

KEY_COLS = ("id", "rn")
LABEL_CANDIDATES = ("target", "flag")


def label_column(df: DataFrame) -> str:
    for c in LABEL_CANDIDATES:
        if c in df.columns:
            return c
    raise KeyError("no target / flag column")


def feature_columns(df: DataFrame, label: Optional[str] = None,
                    exclude: Sequence[str] = ("o_orderkey", "rn_dup", "is_valid", "weight")) -> List[str]:
    label = label or label_column(df)
    return numeric_cols(df, set(KEY_COLS) | {label} | set(exclude))


# ------------------------------------------------------------------ preparation
def median_values(df: DataFrame, cols: Sequence[str]) -> Dict[str, float]:
    q = quantile_table(df, cols, [0.5]).collect()
    return {r["column"]: r["value"] for r in q}


def impute_median(df: DataFrame, cols: Sequence[str], medians: Optional[Dict[str, float]] = None) -> DataFrame:
    """NULL/NaN -> exact column median (linear interpolation between the middle values)."""
    medians = medians if medians is not None else median_values(df, cols)
    fix = {}
    for c in cols:
        x = F.col(c)
        if dict(df.dtypes)[c] in ("float", "double"):
            x = F.nanvl(x, F.lit(None).cast("double"))
        m = medians.get(c)
        fix[c] = F.coalesce(x.cast("double"), F.lit(m).cast("double")) if m is not None else x.cast("double")
    return df.withColumns(fix)


def population_std(df: DataFrame, cols: Sequence[str]) -> Dict[str, float]:
    row = df.agg(*[F.stddev_pop(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return {c: row[c] for c in cols}


def scale_no_center(df: DataFrame, cols: Sequence[str], stds: Optional[Dict[str, float]] = None) -> DataFrame:
    """x / std_pop(x); a zero or undefined std divides by 1 (no centring)."""
    stds = stds if stds is not None else population_std(df, cols)
    fix = {}
    for c in cols:
        s = stds.get(c)
        s = 1.0 if s is None or s == 0 or s != s else s
        fix[c] = F.col(c).cast("double") / F.lit(s)
    return df.withColumns(fix)


IMP = "_imp_"
MISSING = "_isnan_"


def missing_columns(train: DataFrame, cols: Sequence[str]) -> List[str]:
    """Columns with a NULL or NaN among the training rows (one aggregate)."""
    row = train.agg(*[F.max(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).isNull()).alias(c)
                      for c in cols]).first()
    return [c for c in cols if row[c]]


def _impute_stage(cols: Sequence[str], medians: Dict[str, float], flagged: Sequence[str] = ()) -> SQLTransformer:
    """Keeps every input column and adds ``_imp_<c>`` = c with NULL/NaN -> median.

    Scoring data without a label passes through the same saved stage.
    """
    def q(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"
    parts = ["*"]
    for c in cols:
        m = medians.get(c)
        val = "NULL" if m is None or m != m else repr(float(m))
        parts.append(f"COALESCE(nanvl(CAST({q(c)} AS DOUBLE), CAST(NULL AS DOUBLE)), CAST({val} AS DOUBLE))"
                     f" AS {q(IMP + c)}")
    for c in flagged:
        parts.append(f"CAST(nanvl(CAST({q(c)} AS DOUBLE), CAST(NULL AS DOUBLE)) IS NULL AS DOUBLE) AS {q(MISSING + c)}")
    return SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")


def prepare_stages(train: DataFrame, feats: Sequence[str], scale: bool = True, flags: bool = False):
    """Preparation fitted on ``train``: exact-median impute, missing flags, assemble, optional 1/std scaling."""
    medians = median_values(train, feats)
    flagged = missing_columns(train, feats) if flags else []
    stages = [_impute_stage(feats, medians, flagged),
              VectorAssembler(inputCols=[IMP + c for c in feats] + [MISSING + c for c in flagged],
                              outputCol="features_raw" if scale else "features", handleInvalid="keep")]
    if scale:
        imputed = impute_median(train, feats, medians)
        stds = population_std(imputed, feats)
        inv = [1.0 / s if s and s == s else 1.0 for s in (stds[c] for c in feats)] + [1.0] * len(flagged)
        stages.append(ElementwiseProduct(scalingVec=Vectors.dense(inv), inputCol="features_raw",
                                         outputCol="features"))
    return stages


def model_inputs(model: PipelineModel) -> List[str]:
    """Names of the fitted model's vector slots; a missing flag is called ``<column>_isnan``."""
    cols = next(st for st in model.stages if isinstance(st, VectorAssembler)).getInputCols()
    return [c[len(IMP):] if c.startswith(IMP) else c[len(MISSING):] + "_isnan" for c in cols]


# ------------------------------------------------------------------ training
def split_frame(df: DataFrame, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    label = label_column(df)
    lab = df.filter(F.col(label).isNotNull())
    keys = [k for k in KEY_COLS if k in df.columns]
    return stratified_split(lab, test_size, seed, label, keys)


def _fit(df: DataFrame, estimator, feats: Sequence[str], scale: bool, weights: bool, flags: bool = False,
         valid_col: Optional[str] = None) -> PipelineModel:
    """Preparation statistics come from the training rows alone (those where ``valid_col`` is not set)."""
    label = label_column(df)
    data = df.filter(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("double"))
    if weights:
        data = balanced_weights(data, label, "weight")
    train = data.filter(~F.col(valid_col)) if valid_col else data
    stages = prepare_stages(train, feats, scale, flags)
    return Pipeline(stages=stages + [estimator]).fit(data)


def fit_logreg(train: DataFrame, feats: Optional[Sequence[str]] = None, C: float = 1.0,
               l1_ratio: float = 0.5, max_iter: int = 2000, balanced: bool = True,
               tol: float = 1e-4) -> PipelineModel:
    """Elastic-net logistic regression on median-imputed, std-scaled features.

    ``regParam = 1 / (C * n)`` maps the summed-loss penalty onto Spark's mean-loss
    objective; ``tol`` is the original solver's default stopping tolerance.
    Every optimizer iteration is one distributed pass over the training rows.
    """
    feats = list(feats or feature_columns(train))
    n = train.count()
    lr = LogisticRegression(featuresCol="features", labelCol="label", elasticNetParam=l1_ratio,
                            regParam=1.0 / (C * max(n, 1)), maxIter=max_iter, standardization=False, tol=tol)
    if balanced:
        lr.setWeightCol("weight")
    return _fit(train, lr, feats, scale=True, weights=balanced)


def _forest_inputs(train: DataFrame, feats: Sequence[str], balanced: bool = True):
    """(fitted preparation, its written vectors, weight of every class)."""
    label = label_column(train)
    data = train.filter(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("double"))
    data = balanced_weights(data, label, "weight") if balanced else data.withColumn("weight", F.lit(1.0))
    prepared = PipelineModel(prepare_stages(data, feats, scale=False, flags=True))
    keys = [k for k in KEY_COLS if k in train.columns]
    row = F.xxhash64(*keys) if keys else F.monotonically_increasing_id()
    vectors = materialize(prepared.transform(data).select("label", "weight", row.alias("row"), "features"))
    weights = {r["label"]: r["w"] for r in vectors.groupBy("label").agg(F.max("weight").alias("w")).collect()}
    return prepared, vectors, weights


def _forest(n_trees: int, max_depth: int, min_leaf: int, balanced: bool, seed: int) -> RandomForestClassifier:
    rf = RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=n_trees, maxDepth=max_depth,
                                minInstancesPerNode=min_leaf, featureSubsetStrategy="sqrt", seed=seed, cacheNodeIds=True)
    return rf.setWeightCol("weight") if balanced else rf


def fit_rf(train: DataFrame, feats: Optional[Sequence[str]] = None, n_trees: int = 600, max_depth: int = 12,
           min_leaf: int = 2, balanced: bool = True, seed: int = 42) -> PipelineModel:
    """Random forest of the classes 0 and 1; trees grow side by side over byte codes (``forest``).

    Other labels go to Spark's own estimator, where a row's node in every tree is kept between passes.
    """
    feats = list(feats or feature_columns(train))
    rf = _forest(n_trees, max_depth, min_leaf, balanced, seed)
    prepared, vectors, weights = _forest_inputs(train, feats, balanced)
    if set(weights) <= {0.0, 1.0}:
        model = fit_forest(rf, vectors, [weights.get(0.0, 1.0), weights.get(1.0, 1.0)])
    else:
        model = rf.fit(vectors)
    return PipelineModel([*prepared.stages, model])


def fit_gbt(train: DataFrame, feats: Optional[Sequence[str]] = None, max_iter: int = 100,
            step: float = 0.03, max_depth: int = 8, subsample: float = 0.9, colsample: float = 0.8,
            valid_col: Optional[str] = None, seed: int = 42, min_child: int = 5, patience: int = 200) -> PipelineModel:
    """Boosted trees; ``valid_col`` (a boolean column) marks rows for early stopping.

    Medians, missing flags and trees are fitted on the other rows alone.  The model
    ends at the round with the best ROC-AUC on the marked rows, found when
    ``patience`` further rounds bring no better one (``boosting.fit_with_patience``).
    """
    feats = list(feats or feature_columns(train))

    def booster(rounds: int) -> GBTClassifier:
        return GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, stepSize=step,
                             maxDepth=max_depth, subsamplingRate=subsample, featureSubsetStrategy=str(colsample),
                             seed=seed, minInstancesPerNode=min_child)
    if not valid_col:
        return _fit(train, booster(max_iter), feats, scale=False, weights=False, flags=True)
    label = label_column(train)
    data = train.filter(F.col(label).isNotNull()).withColumn("label", F.col(label).cast("double"))
    prepared = Pipeline(stages=prepare_stages(data.filter(~F.col(valid_col)), feats, scale=False, flags=True)).fit(data)
    keys = [k for k in KEY_COLS if k in train.columns]
    vectors = prepared.transform(data).select(*keys, "label", F.col(valid_col).alias("_valid"), "features")
    # few tasks in one order: a boosting round is a job per tree level, and a longer fit repeats a shorter one
    vectors = materialize(vectors.repartition(max(1, -(-data.count() // ROWS_A_TASK)), *keys).sortWithinPartitions(*keys))
    model, _ = fit_with_patience(booster, vectors.filter(~F.col("_valid")), vectors.filter("_valid"), max_iter, patience)
    return PipelineModel(stages=[*prepared.stages, model])


# ------------------------------------------------------------------ scoring
def predict_batch(model: PipelineModel, df: DataFrame, proba: bool = True,
                  id_cols: Optional[Sequence[str]] = None) -> DataFrame:
    """Probability of class 1 (``pred_proba``) or the label (``pred_label``), id columns first.

    ``id_cols=None`` stands for the key columns, an empty sequence for scores alone.
    """
    ids = [c for c in (KEY_COLS if id_cols is None else id_cols) if c in df.columns]
    out = model.transform(df)
    if proba:
        return out.select(*ids, vector_to_array("probability")[1].alias("pred_proba"))
    return out.select(*ids, F.col("prediction").cast("int").alias("pred_label"))


def evaluate_model(model: PipelineModel, valid: DataFrame, name: str = "model") -> DataFrame:
    label = label_column(valid)
    pred = predict_batch(model, valid, id_cols=list(KEY_COLS) + [label])
    return evaluate_binary(pred, label, "pred_proba", name)


def feature_importance_topk(model: PipelineModel, feats: Optional[Sequence[str]] = None, k: int = 20) -> DataFrame:
    """Impurity importances of the tree stage, top-k (ties by name); names come from the model."""
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(model_inputs(model), imp)]
    return spark.createDataFrame(rows, "feature string, importance double") \
        .orderBy(F.desc("importance"), "feature").limit(k)


def partner_rows(df: DataFrame, keys: Sequence[str], seed: int, cols: Sequence[str]) -> DataFrame:
    """``df`` with a struct ``_partner`` of ``cols`` from another row: one random permutation of all rows.

    Row i of one hash order meets row i of a second hash order, by exact positions,
    so the result depends on keys and seed alone, not on partitions.
    """
    def placed(frame, salt):
        h = frame.withColumn("_u", unit_hash(keys, salt)).withColumn("_h", row_hash_key(keys, salt))
        return global_index(h, "_u", tiebreak=["_h", *keys]).drop("_u", "_h")
    own = placed(df, seed)
    other = placed(df.select(*keys, F.struct(*cols).alias("_partner")), seed + 1).select("pos", "_partner")
    return own.join(other, "pos").drop("pos")


def permute_column(df: DataFrame, col: str, seed: int, keys: Sequence[str]) -> DataFrame:
    """One column's values shuffled across all rows."""
    return partner_rows(df, keys, seed, [col]).withColumn(col, F.col(f"_partner.{col}")).drop("_partner")


def _permuted(last, ready: DataFrame, label: str, keys, slots, feats, n_repeats: int, seed: int) -> DataFrame:
    """(repeat, feature, roc_auc) of any model: every row is scored whole, once per feature and repeat."""
    ready = materialize(ready.select(*keys, F.col(label).cast("int").alias("_y"), vector_to_array("features").alias("_x")))
    base = ready.select("_y", "_x", F.lit(-1).alias("repeat"), F.lit("").alias("feature"))
    table = F.array(*[F.struct(F.lit(f).alias("f"), F.array(*[F.lit(i) for i in slots[f]]).alias("s")) for f in feats])
    frames = [base]
    for r in range(n_repeats):
        met = partner_rows(ready, keys, seed + 1000 * r, ["_x"])
        met = met.select("_y", "_x", F.col("_partner._x").alias("_p"), F.explode(table).alias("_f"))
        frames.append(met.select("_y", F.expr("transform(_x, (x, i) -> if(array_contains(_f.s, i), _p[i], x))").alias("_x"),
                                 F.lit(r).alias("repeat"), F.col("_f.f").alias("feature")))
    rows = frames[0]
    for f in frames[1:]:
        rows = rows.unionByName(f)
    scored = last.transform(rows.select("_y", "repeat", "feature", array_to_vector("_x").alias("features")))
    return roc_auc_by(scored.select("repeat", "feature", "_y", vector_to_array("probability")[1].alias("_s")),
                      ["repeat", "feature"], "_y", "_s")


def _forest_permuted(last: ForestModel, ready: DataFrame, label: str, keys, slots, feats, n_repeats: int, seed: int) -> DataFrame:
    """(repeat, feature, roc_auc) of a forest: rows and partners meet as bytes of codes (``permuted``)."""
    codes = codes_of(ready.sparkSession.sparkContext.broadcast(last.forest))
    ready = materialize(ready.select(*keys, F.col(label).cast("int").alias("_y"), codes.alias("_x")))

    def partners(r: int) -> DataFrame:
        return partner_rows(ready, keys, seed + 1000 * r, ["_x"]).select("_y", "_x", F.col("_partner._x").alias("_p"))
    return permuted_auc(last.forest, ready, partners, [slots[f] for f in feats], feats, n_repeats)


def permutation_importance(model: PipelineModel, valid: DataFrame, feats: Optional[Sequence[str]] = None,
                           n_repeats: int = 5, seed: int = 42) -> DataFrame:
    """Mean, std, min and max of the ROC-AUC drop when one feature's values are shuffled on the holdout.

    All features and repeats are scored in one job: every row meets a partner per
    repeat and is scored once per feature with that feature's slots (value and
    missing flag) taken from the partner.  A forest goes down anew only where that can
    change a leaf.
    """
    label = label_column(valid)
    keys = [k for k in KEY_COLS if k in valid.columns]
    slots: Dict[str, List[int]] = {}
    for i, name in enumerate(model_inputs(model)):
        base = name[:-len("_isnan")] if name.endswith("_isnan") else name
        slots.setdefault(base, []).append(i)
    feats = [f for f in (feats if feats is not None else slots) if f in slots]
    ready = PipelineModel(model.stages[:-1]).transform(valid.filter(F.col(label).isNotNull()))
    auc = materialize(_forest_permuted(model.stages[-1], ready, label, keys, slots, feats, n_repeats, seed)
                      if isinstance(model.stages[-1], ForestModel) and n_repeats and feats
                      else _permuted(model.stages[-1], ready, label, keys, slots, feats, n_repeats, seed))
    whole = auc.filter(F.col("repeat") == -1).first()["roc_auc"]
    drop = F.lit(whole).cast("double") - F.col("roc_auc")
    return (auc.filter(F.col("repeat") >= 0).groupBy("feature").agg(
        F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std"),
        F.min(drop).alias("importance_min"), F.max(drop).alias("importance_max"))
        .orderBy(F.desc("importance_mean"), "feature"))


def match_groups(columns: Sequence[str], patterns: Dict[str, str]) -> Dict[str, List[str]]:
    """Columns of each group by a regular expression on their names."""
    return {g: [c for c in columns if re.search(p, c)] for g, p in patterns.items()}


def _ablated_forests(train: DataFrame, valid: DataFrame, feats: Sequence[str], seed: int):
    """Columns -> ROC-AUC on ``valid`` of the forest on them alone; None where labels are others than 0 and 1."""
    prepared, vectors, weights = _forest_inputs(train, feats)
    if not set(weights) <= {0.0, 1.0}:
        return None
    data = coded(vectors, [weights.get(0.0, 1.0), weights.get(1.0, 1.0)])
    inputs = prepared.stages[-1].getInputCols()
    keys = [k for k in KEY_COLS if k in valid.columns]
    ready = materialize(prepared.transform(valid).select(*keys, label_column(valid), F.col("features").alias("_all")))

    def auc(cols):
        own = {IMP + c for c in cols} | {MISSING + c for c in cols}
        slots = [i for i, name in enumerate(inputs) if name in own]
        forest = fit_coded(_forest(100, 10, 2, True, seed), data, slots)
        model = PipelineModel([VectorSlicer(inputCol="_all", outputCol="features", indices=slots), forest])
        return evaluate_model(model, ready).first()["roc_auc"]
    return auc


def group_ablation(df: DataFrame, groups: Dict[str, Sequence[str]], fit=None, seed: int = 42,
                   test_size: float = 0.25, workers: int = 4) -> DataFrame:
    """AUC change when each group of columns is removed (same split, same estimator).

    ``match_groups`` makes groups from patterns.  Fits run side by side in
    ``workers`` threads.  A group without columns in the frame is not fitted:
    (group, 0, NULL, NULL).  Without ``fit`` every group has the forest
    ``fit_rf(rows, columns, n_trees=100, max_depth=10)``; a column's median, flag and
    bins are those of any group, so rows are prepared and coded once for all.
    """
    spark = df.sparkSession
    sp = materialize(split_frame(df, test_size, seed))
    train, valid = sp.filter(~F.col("is_valid")), sp.filter(F.col("is_valid"))
    all_feats = feature_columns(df)
    there = {g: [c for c in cols if c in all_feats] for g, cols in groups.items()}
    kept = {None: all_feats} | {g: [c for c in all_feats if c not in cols] for g, cols in there.items() if cols}
    kept = {g: cols for g, cols in kept.items() if cols}

    auc = _ablated_forests(train, valid, all_feats, seed) if fit is None else None
    if auc is None:
        one = fit or (lambda tr, fs: fit_rf(tr, fs, n_trees=100, max_depth=10, seed=seed))

        def auc(cols):
            return evaluate_model(one(train, cols), valid).first()["roc_auc"]

    with ThreadPoolExecutor(workers) as pool:
        got = dict(zip(kept, pool.map(inheritable_thread_target(spark)(auc), kept.values())))
    full = got[None]
    rows = [("__all__", len(all_feats), full, 0.0)]
    for g, cols in there.items():
        a = got.get(g)
        rows.append((g, len(cols), a, a - full if a is not None and full is not None else None))
    return spark.createDataFrame(rows, "group string, n_cols int, roc_auc double, delta_auc double")


def stratified_folds(df: DataFrame, n_folds: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold = position within the class modulo ``n_folds``: sizes differ by at most one per class.

    The order is a hash with its own salt, so folds are independent of a split
    that was cut on the plain seed.
    """
    label = label_column(df)
    keys = [k for k in KEY_COLS if k in df.columns]
    h = df.filter(F.col(label).isNotNull()).withColumn("_u", unit_hash([*keys], seed + 7919)) \
        .withColumn("_h", row_hash_key(keys, seed + 7919))
    placed = global_index(h, "_u", partition_cols=[label], tiebreak=["_h", *keys])
    return placed.withColumn(out, F.pmod("pos", F.lit(n_folds)).cast("int")).drop("_u", "_h", "pos")


# ------------------------------------------------------------------ persistence / batch job
def model_persist(model: PipelineModel, path: str, metadata: Optional[dict] = None) -> str:
    model.write().overwrite().save(path)
    if metadata is not None:
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(json.dumps(metadata, default=str, sort_keys=True),)], "value string") \
            .coalesce(1).write.mode("overwrite").text(path.rstrip("/") + "_meta")
    return path


def persist_run(model: PipelineModel, path: str, train: DataFrame, valid: DataFrame, name: str,
                params: Optional[dict] = None, seed: Optional[int] = None) -> str:
    """Save a model with what it takes to judge it later: scores on ``valid``, sizes, inputs, parameters, seed."""
    ev = evaluate_model(model, valid, name).first()
    label = label_column(train)
    size = train.filter(F.col(label).isNotNull()).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(label).cast("double")).alias("rate")).first()
    inputs = next(st for st in model.stages if isinstance(st, VectorAssembler)).getInputCols()
    return model_persist(model, path, {
        "model": name, "params": params or {}, "seed": seed, "features": [c[len(IMP):] for c in inputs if c.startswith(IMP)],
        "roc_auc": ev["roc_auc"], "auc_pr": ev["auc_pr"], "best_f1": ev["best_f1"], "best_threshold": ev["best_threshold"],
        "n_train": size["n"], "n_valid": ev["n_samples"], "positive_rate": size["rate"], "spark": train.sparkSession.version})


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def read_metadata(spark: SparkSession, path: str) -> dict:
    row = spark.read.text(path.rstrip("/") + "_meta").first()
    return json.loads(row["value"]) if row else {}


def inference_job(spark: SparkSession, input_path: str, output_path: str, model_path: str,
                  id_cols: Optional[Sequence[str]] = None, proba: bool = True) -> str:
    """Read (by suffix) -> load model -> predict -> CSV."""
    from ledgerlens.sources.io import scan_by_suffix, sink_csv
    df = scan_by_suffix(spark, input_path)
    model = load_model(model_path)
    return sink_csv(predict_batch(model, df, proba, id_cols), output_path)

