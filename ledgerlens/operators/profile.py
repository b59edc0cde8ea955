"""Profiling and data-quality checks as aggregate jobs.

Every statistic is an aggregate with a map-side partial step; wide statistics
(all columns at once) are batched into a few ``agg`` calls, and per-value
counts go through ``groupBy`` so no column's values are ever buffered whole.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable, List, Optional, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerlens.operators.quantiles import quantile_table

PROF_PERCENTILES = (0.01, 0.05, 0.5, 0.95, 0.99)


def _is_missing(df: DataFrame, c: str) -> F.Column:
    t = dict(df.dtypes)[c]
    m = F.col(c).isNull()
    if t in ("float", "double"):
        m = m | F.isnan(F.col(c))
    return m


def _clean(df: DataFrame, c: str) -> F.Column:
    t = dict(df.dtypes)[c]
    if t in ("float", "double"):
        return F.nanvl(F.col(c), F.lit(None).cast(t))
    return F.col(c)


def numeric_cols(df: DataFrame, exclude: Iterable[str] = ()) -> List[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType) and f.name not in ex]


def long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value-as-string) rows; NaN counts as missing (NULL)."""
    arr = F.array(*[F.struct(F.lit(c).alias("column"), _clean(df, c).cast("string").alias("value"))
                    for c in cols])
    return df.select(F.explode(arr).alias("kv")).select("kv.column", "kv.value")


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct values per column counting NULL as one value (``nunique(dropna=False)``)."""
    if approx:
        row = df.agg(*[(F.approx_count_distinct(c) + F.max(_is_missing(df, c).cast("int"))).alias(c)
                       for c in cols])
        arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("bigint").alias("n_unique"))
                        for c in cols])
        return row.select(F.explode(arr).alias("x")).select("x.*")
    by_type: dict[str, list[str]] = {}
    for c in cols:
        by_type.setdefault(dict(df.dtypes)[c], []).append(c)
    # values keep their types: columns of one type are counted together, duplicates go before the shuffle
    parts = [df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _clean(df, c).alias("value")) for c in same])).alias("kv"))
             .select("kv.column", "kv.value").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
             for same in by_type.values()]
    return reduce(DataFrame.unionByName, parts)


def null_rates(df: DataFrame) -> DataFrame:
    """(n_rows, column, null_rate) of every column, one aggregate."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.avg(_is_missing(df, c).cast("double")).alias(c) for c in df.columns])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_rate")) for c in df.columns])
    return row.select(F.col("_n").alias("n_rows"), F.explode(arr).alias("x")).select("n_rows", "x.column", "x.null_rate")


def prof_basic(df: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Per column: dtype, rows, null rate and distinct count (NULL counted once)."""
    cols = df.columns
    nulls = null_rates(df)
    types = df.sparkSession.createDataFrame([(c, t) for c, t in df.dtypes], "column string, dtype string")
    nun = distinct_counts(df, cols, approx_distinct)
    return (types.join(nulls, "column").join(nun, "column", "left")
            .select("column", "dtype", "n_rows", F.lit(len(cols)).alias("n_cols"), "null_rate",
                    F.coalesce("n_unique", F.lit(0)).cast("bigint").alias("n_unique")))


def prof_missing_top(df: DataFrame, k: int = 25) -> DataFrame:
    """Top-k missing rates (ties by column name); one aggregate, no distinct counts."""
    return null_rates(df).select("column", "null_rate").orderBy(F.desc("null_rate"), "column").limit(k)


def prof_numeric(df: DataFrame, cols: Optional[Sequence[str]] = None,
                 percentiles: Sequence[float] = PROF_PERCENTILES, exact: bool = True) -> DataFrame:
    """count, mean, std (sample), min, percentiles, max per numeric column."""
    cols = list(cols) if cols is not None else numeric_cols(df)
    stats = df.agg(*[F.struct(F.count(_clean(df, c)).alias("count"), F.avg(_clean(df, c)).alias("mean"),
                              F.stddev_samp(_clean(df, c)).alias("std"),
                              F.min(_clean(df, c)).cast("double").alias("min"),
                              F.max(_clean(df, c)).cast("double").alias("max")).alias(c) for c in cols])
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("s")) for c in cols])
    base = stats.select(F.explode(arr).alias("x")).select("x.column", "x.s.*")
    q = quantile_table(df, cols, percentiles, exact=exact)
    names = {p: "p" + format(p * 100, "g").replace(".", "_") for p in percentiles}
    piv = q.groupBy("column").agg(*[F.max(F.when(F.abs(F.col("p") - F.lit(p)) < 1e-12, F.col("value")))
                                    .alias(names[p]) for p in percentiles])
    out = base.join(piv, "column", "left")
    return out.select("column", "count", "mean", "std", "min", *[names[p] for p in percentiles], "max")


def prof_categorical(df: DataFrame, cols: Sequence[str], top_k: int = 10) -> DataFrame:
    """Per column: distinct count (NULL included) and ``"value:count, ..."`` of the top-k values.

    The ``row_number() <= k`` filter is planned with a per-partition group limit
    ahead of the shuffle, so a high-cardinality column ships at most k rows per
    map task.  Ties go to the smaller value; NULL prints as ``nan``.
    """
    counts = long_values(df, cols).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("column").orderBy(F.desc("n"), F.asc_nulls_last("value"))
    top = counts.withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= top_k)
    txt = top.groupBy("column").agg(F.array_sort(F.collect_list(F.struct("pos", "value", "n"))).alias("t"))
    txt = txt.select("column", F.array_join(F.transform(
        "t", lambda x: F.concat(F.coalesce(x["value"], F.lit("nan")), F.lit(":"), x["n"].cast("string"))),
        ", ").alias("top_values"))
    nun = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_unique"))
    return nun.join(txt, "column").select("column", "n_unique", "top_values")


def hist_equal_width(df: DataFrame, cols: Optional[Sequence[str]] = None, bins: int = 50) -> DataFrame:
    """Equal-width histogram per numeric column (last bin right-closed).

    A constant column uses the range (v - 0.5, v + 0.5).  Output: non-empty bins
    (column, bin, lower, upper, count).
    """
    cols = list(cols) if cols is not None else numeric_cols(df)
    rng = df.agg(*[F.min(_clean(df, c)).cast("double").alias(f"mn_{i}") for i, c in enumerate(cols)],
                 *[F.max(_clean(df, c)).cast("double").alias(f"mx_{i}") for i, c in enumerate(cols)]).first()
    parts = []
    for i, c in enumerate(cols):
        mn, mx = rng[f"mn_{i}"], rng[f"mx_{i}"]
        if mn is None:
            continue
        if mn == mx:
            mn, mx = mn - 0.5, mx + 0.5
        parts.append(F.struct(F.lit(c).alias("column"), F.lit(mn).alias("lo"), F.lit(mx).alias("hi"),
                              _clean(df, c).cast("double").alias("v")))
    if not parts:
        return df.sparkSession.createDataFrame([], "column string, bin int, lower double, upper double, count bigint")
    x = df.select(F.explode(F.array(*parts)).alias("x")).select("x.*").filter(F.col("v").isNotNull())
    b = F.least(F.floor((F.col("v") - F.col("lo")) * F.lit(float(bins)) / (F.col("hi") - F.col("lo"))),
                F.lit(bins - 1)).cast("int")
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return (x.withColumn("bin", b).groupBy("column", "bin", "lo", "hi").agg(F.count(F.lit(1)).alias("count"))
            .select("column", "bin", (F.col("lo") + F.col("bin") * width).alias("lower"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("upper"), "count"))


VARIANCE_NOISE = 1e-11
_MOMENT_SCHEMA = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"


def _partition_moments(shift, pairs_i, pairs_j):
    """Per partition: pairwise-complete shifted sums for the requested (i, j) pairs.

    Nulls are NaN in the Arrow batches; M = present mask, X0 = shifted values
    with 0 where missing.  n = M'M, Sx = X0'M, Sxx = (X0*X0)'M, Sxy = X0'X0 give,
    for each pair, the count and sums over the rows where both are present.
    One small table of len(pairs) rows leaves each partition.
    """
    import numpy as np
    import pandas as pd

    sh = np.asarray(shift, dtype="float64")
    ii, jj = np.asarray(pairs_i), np.asarray(pairs_j)

    def run(batches):
        acc = None
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = pdf.to_numpy(dtype="float64", na_value=np.nan) - sh
            m = (~np.isnan(x)).astype("float64")
            x0 = np.where(m > 0, x, 0.0)
            cur = (m.T @ m, x0.T @ m, (x0 * x0).T @ m, x0.T @ x0)
            acc = cur if acc is None else tuple(a + b for a, b in zip(acc, cur))
        if acc is None:
            return
        n, sx, sxx, sxy = acc
        yield pd.DataFrame({"i": ii.astype("int32"), "j": jj.astype("int32"), "n": n[ii, jj],
                            "sx": sx[ii, jj], "sy": sx[jj, ii], "sxx": sxx[ii, jj], "syy": sxx[jj, ii],
                            "sxy": sxy[ii, jj]})
    return run


def pair_correlations(df: DataFrame, cols: Sequence[str], pairs: Sequence[tuple]) -> DataFrame:
    """Pearson r for (a, b) pairs, pairwise-complete, in ONE pass over the data.

    Columns are shifted by their means (one cheap aggregate) so the sums stay
    accurate; each partition emits one row per pair (numpy matrix products on
    its Arrow batches), Spark sums them per pair with a map-side partial
    aggregate, and r = (n Sxy - Sx Sy) / sqrt((n Sxx - Sx^2)(n Syy - Sy^2))
    is finished in JVM expressions.  A side without variance on the pair's rows
    gives NULL (below ``VARIANCE_NOISE`` of its second moment it is rounding noise).
    Output: (col_a, col_b, corr).
    """
    spark = df.sparkSession
    cols = list(cols)
    pos = {c: k for k, c in enumerate(cols)}
    narrow = df.select(*[_clean(df, c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    means = narrow.agg(*[F.avg(f"c{k}").alias(f"c{k}") for k in range(len(cols))]).first()
    shift = [float(means[f"c{k}"]) if means[f"c{k}"] is not None else 0.0 for k in range(len(cols))]
    pi = [pos[a] for a, _ in pairs]
    pj = [pos[b] for _, b in pairs]
    stats = narrow.mapInPandas(_partition_moments(shift, pi, pj), _MOMENT_SCHEMA)
    tot = stats.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    vx = n * F.col("sxx") - sx * sx
    vy = n * F.col("syy") - sy * sy
    num = n * F.col("sxy") - sx * sy
    # a side that is constant on the pair's rows leaves rounding noise against n * Sxx: no variance
    real = (vx > VARIANCE_NOISE * n * F.col("sxx")) & (vy > VARIANCE_NOISE * n * F.col("syy"))
    r = F.when((n > 0) & real & (vx > 0) & (vy > 0), num / F.sqrt(vx * vy))
    r = F.when(r > 1.0, F.lit(1.0)).when(r < -1.0, F.lit(-1.0)).otherwise(r)
    names = spark.createDataFrame([(k, c) for c, k in pos.items()], "k int, name string")
    na = names.select(F.col("k").alias("i"), F.col("name").alias("col_a"))
    nb = names.select(F.col("k").alias("j"), F.col("name").alias("col_b"))
    return (tot.select("i", "j", r.alias("corr")).join(F.broadcast(na), "i").join(F.broadcast(nb), "j")
            .select("col_a", "col_b", "corr"))


def corr_matrix(df: DataFrame, cols: Optional[Sequence[str]] = None) -> DataFrame:
    """Pearson correlation of every pair (i < j), pairwise-complete, as (col_a, col_b, corr)."""
    cols = list(cols) if cols is not None else numeric_cols(df)
    pairs = [(a, b) for k, a in enumerate(cols) for b in cols[k + 1:]]
    return pair_correlations(df, cols, pairs)


def corr_top_pairs(df: DataFrame, k: int = 30, threshold: float = 0.98,
                   cols: Optional[Sequence[str]] = None) -> DataFrame:
    """Top-k |r| pairs of the upper triangle; flag |r| >= threshold.

    |r| values equal to 9 decimals count as ties and keep column order.
    """
    cols = list(cols) if cols is not None else numeric_cols(df)
    order = {c: i for i, c in enumerate(cols)}
    cm = corr_matrix(df, cols).filter(F.col("corr").isNotNull())
    idx = df.sparkSession.createDataFrame(list(order.items()), "c string, i int")
    ia, ib = idx.withColumnRenamed("c", "col_a").withColumnRenamed("i", "ia"), \
        idx.withColumnRenamed("c", "col_b").withColumnRenamed("i", "ib")
    return (cm.join(ia, "col_a").join(ib, "col_b")
            .select("col_a", "col_b", F.abs("corr").alias("abs_corr"), "ia", "ib")
            .orderBy(F.desc(F.round("abs_corr", 9)), "ia", "ib").limit(k)
            .select("col_a", "col_b", "abs_corr", (F.col("abs_corr") >= threshold).alias("flag_high")))


def corr_with_target(df: DataFrame, target: str = "target", k: int = 20,
                     exclude: Iterable[str] = ("id", "rn")) -> DataFrame:
    """Top-k features by |corr(feature, target)| in one aggregate."""
    feats = numeric_cols(df, set(exclude) | {target})
    cm = pair_correlations(df, feats + [target], [(c, target) for c in feats])
    t = cm.select(F.col("col_a").alias("feature"), "corr").filter(F.col("corr").isNotNull())
    return t.select("feature", "corr", F.abs("corr").alias("abs_corr")) \
        .orderBy(F.desc(F.round("abs_corr", 9)), "feature").limit(k)


def identical_columns(df: DataFrame, ignore: Iterable[str] = (), keys: Sequence[str] = ("id", "rn")) -> DataFrame:
    """Groups of columns holding the same type and the same value on every row.

    Pass 1 fingerprints each column in one aggregate: ``bit_xor`` over rows of
    ``xxhash64(row key, value)`` (identical columns always get equal
    fingerprints).  Pass 2 verifies candidates exactly with ``bool_and(a <=> b)``
    against each group's first column, so hash collisions never merge columns.
    Output: (column, group_first) for groups of two or more.
    """
    ign = set(ignore) | set(keys)
    kcols = [k for k in keys if k in df.columns]
    types = dict(df.dtypes)
    cols = [c for c in df.columns if c not in ign and not types[c].startswith(("map", "array", "struct"))]
    rowkey = [F.col(k) for k in kcols] if kcols else [F.lit(0)]
    fp = df.agg(*[F.bit_xor(F.xxhash64(*rowkey, F.col(c)))
                  .alias(f"h{i}") for i, c in enumerate(cols)]).first() if cols else None
    buckets = {}
    for i, c in enumerate(cols):
        buckets.setdefault((types[c], fp[f"h{i}"] if fp else 0), []).append(c)
    candidates = [g for g in buckets.values() if len(g) > 1]
    groups: List[List[str]] = []
    while candidates:
        checks = [(g[0], m) for g in candidates for m in g[1:]]
        r = df.agg(*[F.bool_and(F.col(a).eqNullSafe(F.col(b))).alias(f"e{i}")
                     for i, (a, b) in enumerate(checks)]).first()
        eq = {(a, b): bool(r[f"e{i}"]) if r[f"e{i}"] is not None else True for i, (a, b) in enumerate(checks)}
        nxt = []
        for g in candidates:
            same = [g[0]] + [m for m in g[1:] if eq[(g[0], m)]]
            rest = [m for m in g[1:] if not eq[(g[0], m)]]
            if len(same) > 1:
                groups.append(same)
            if len(rest) > 1:
                nxt.append(rest)
        candidates = nxt
    rows = [(c, g[0]) for g in groups for c in g]
    return df.sparkSession.createDataFrame(rows, "column string, group_first string")


def qc_postcheck(df: DataFrame, target: str = "target", keys: Sequence[str] = ("id", "rn"),
                 top: int = 10) -> DataFrame:
    """Shape, NULL totals, duplicate keys, target distribution and top NULL columns.

    Rows ``(metric, key, value)``; duplicates = sum(count - 1) over key groups.
    """
    spark = df.sparkSession
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(_is_missing(df, c).cast("long")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    n = row["_n"]
    miss = {c: row[f"m{i}"] or 0 for i, c in enumerate(cols)}
    total = sum(miss.values())
    rows = [("rows", None, float(n)), ("columns", None, float(len(cols))), ("nans_total", None, float(total)),
            ("nan_rate_pct", None, (100.0 * total / (n * len(cols))) if n else None)]
    tops = sorted(cols, key=lambda c: (-(miss[c] / n if n else 0), c))[:top]
    rows += [("null_pct", c, (100.0 * miss[c] / n) if n else None) for c in tops]
    meta = spark.createDataFrame(rows, "metric string, key string, value double")
    kc = [k for k in keys if k in cols] or cols
    dup = df.groupBy(*kc).count().agg(F.sum(F.col("count") - 1).cast("double").alias("value")) \
        .select(F.lit("duplicates").alias("metric"), F.lit(None).cast("string").alias("key"), "value")
    out = meta.unionByName(dup)
    if target in cols:
        # one row per target class (0, 1, NULL) over the row count n
        dist = df.groupBy(target).count().select(
            F.lit("target_dist").alias("metric"), F.coalesce(F.col(target).cast("string"), F.lit("null")).alias("key"),
            (F.col("count") / F.lit(float(n))).alias("value"))
        out = out.unionByName(dist)
    return out


def qc_labels(df: DataFrame, labels: DataFrame, key: str = "id", target: str = "target") -> DataFrame:
    """Rows with/without target, missing rate, duplicated label ids, label coverage of the ids."""
    a = df.agg(F.count(F.lit(1)).alias("rows_total"),
               F.count(target).alias("rows_with_target"))
    a = a.withColumn("missing_target_rate", F.col("rows_total").cast("double") - F.col("rows_with_target"))
    a = a.withColumn("missing_target_rate", F.col("missing_target_rate") / F.col("rows_total"))
    lab = labels.agg((F.count(F.lit(1)) - F.count_distinct(key)).alias("label_dup_ids"),
                     F.count_distinct(key).alias("label_ids"))
    ids = df.select(key).distinct()
    cov = ids.join(labels.select(key).distinct().withColumn("_m", F.lit(1)), key, "left") \
        .agg(F.avg(F.coalesce("_m", F.lit(0)).cast("double")).alias("label_coverage"))
    return _one_row(a, lab, cov)


def _one_row(*frames: DataFrame) -> DataFrame:
    """Side-by-side combination of one-row aggregate frames.

    Each frame is a single aggregate row (a few numbers), so the rows are
    brought to the driver and put together there instead of joining on a
    constant key.
    """
    from pyspark.sql.types import StructType
    spark = frames[0].sparkSession
    fields, values = [], []
    for f in frames:
        row = f.first()
        fields += list(f.schema.fields)
        values += list(row) if row is not None else [None] * len(f.columns)
    return spark.createDataFrame([tuple(values)], StructType(fields))


def qc_cardinality(df: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Rows, unique ids, rows per id and id coverage by the label file."""
    a = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("unique_ids"))
    a = a.withColumn("rows_per_id", F.col("rows") / F.col("unique_ids"))
    inter = df.select(key).distinct().join(labels.select(key).distinct(), key, "left_semi") \
        .agg(F.count(F.lit(1)).alias("ids_with_label"))
    out = _one_row(a, inter)
    return out.withColumn("id_coverage", F.col("ids_with_label") / F.col("unique_ids"))


def pos_rate(df: DataFrame, target: str = "target", by: Optional[str] = None) -> DataFrame:
    if by:
        return df.groupBy(by).agg(F.avg(F.col(target).cast("double")).alias("pos_rate"),
                                  F.count(target).alias("n"))
    return df.agg(F.avg(F.col(target).cast("double")).alias("pos_rate"), F.count(target).alias("n"))


def feature_catalogue(df: DataFrame, why: dict) -> DataFrame:
    """One row per generated feature: name, justification, dtype, null rate, distinct count."""
    feats = [c for c in df.columns if c in why]
    spark = df.sparkSession
    notes = spark.createDataFrame([(c, why[c]) for c in feats], "column string, why string")
    prof = prof_basic(df.select(*feats)) if feats else None
    if prof is None:
        return notes
    return notes.join(prof, "column").select("column", "why", "dtype", "null_rate", "n_unique")
