"""Per-group sequence numbers and lagged values without a per-group task.

``row_number()`` and ``lag()`` over ``Window.partitionBy(group)`` put every row
of a group into one task; a group holding a third of all rows would then run
alone.  Here groups larger than a fair share of the rows (``rows / parts``;
at most ``parts`` such groups exist) are cut into consecutive slices along the
first order column, at approximate-quantile boundaries.  Each (group, slice)
is numbered and lagged locally; a small table with one row per slice (its row
count and last ``n_lags`` values) supplies each slice's offset and the values
carried in from the slices before it.

The slice boundaries are computed once and handed back as a small table
(about ``2 * parts`` numbers in total), so every branch of the plan sees the
same slices.
"""

from __future__ import annotations

import math
from typing import Optional, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, DoubleType, IntegerType, StructField, StructType,
                               TimestampNTZType, TimestampType)


def _numeric_order(df: DataFrame, c: str) -> F.Column:
    t = df.schema[c].dataType
    if isinstance(t, (TimestampType, TimestampNTZType, DateType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return F.col(c).cast("double")


def hot_group_slices(df: DataFrame, group: str, order_col: str, n_parts: int,
                     accuracy: int = 10_000) -> Optional[DataFrame]:
    """(group, _bounds) for groups above ``rows / n_parts`` rows, else None.

    A group of ``c`` rows gets ``ceil(c / share)`` slices; all boundary lists
    together hold fewer than ``2 * n_parts`` numbers.
    """
    spark = df.sparkSession
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("_c"))
    st = counts.agg(F.sum("_c").alias("t"), F.max("_c").alias("m")).first()
    total, biggest = (st["t"] or 0), (st["m"] or 0)
    share = max(1, math.ceil(total / max(1, n_parts)))
    if biggest <= share:  # the common case: one aggregate job and done
        return None
    hot = counts.filter(F.col("_c") > share).collect()  # at most n_parts rows
    if not hot:
        return None
    k_max = max(math.ceil(r["_c"] / share) for r in hot)
    steps = {r[group]: max(1, k_max // math.ceil(r["_c"] / share)) for r in hot}
    key_field = df.schema[group]
    hot_df = spark.createDataFrame([(r[group], steps[r[group]]) for r in hot],
                                   StructType([key_field, StructField("_step", IntegerType())]))
    probs = [i / k_max for i in range(1, k_max)]
    num = _numeric_order(df, order_col)
    edges = (df.join(F.broadcast(hot_df), group).groupBy(group, "_step")
             .agg(F.percentile_approx(num, probs, max(accuracy, 20 * k_max)).alias("_e"))
             .select(group, F.filter("_e", lambda x, i: (i + 1) % F.col("_step") == 0).alias("_bounds"))
             .collect())
    rows = [(r[group], sorted(set(r["_bounds"] or []))) for r in edges]
    return spark.createDataFrame(rows, StructType([key_field, StructField("_bounds", ArrayType(DoubleType()))]))


def numbered_history(df: DataFrame, group: str, order: Sequence[str], value: str, n_lags: int,
                     seq_col: str = "seq", lag_prefix: str = "lag_",
                     n_parts: Optional[int] = None, sizes_from: Optional[DataFrame] = None) -> DataFrame:
    """Add ``seq`` (1-based position in the group along ``order``) and
    ``lag_1 .. lag_n`` (``value`` of the row ``i`` positions earlier, NULL before the start).

    ``order`` must make rows unique within a group.  ``sizes_from`` is a
    cheaper frame with the same rows' group and order columns (e.g. the table
    before a 1:1 left join) used to find the large groups.
    """
    if n_parts is None:
        n_parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    bounds = hot_group_slices(sizes_from if sizes_from is not None else df, group, order[0], n_parts)
    if bounds is None:
        # no group above rows / n_parts: one window per group is already bounded
        w = Window.partitionBy(group).orderBy(*order)
        return df.select(*df.columns, F.row_number().over(w).cast("int").alias(seq_col),
                         *[F.lag(value, i).over(w).alias(f"{lag_prefix}{i}") for i in range(1, n_lags + 1)])
    num = _numeric_order(df, order[0])
    sliced = (df.join(F.broadcast(bounds), group, "left")
              .withColumn("_slice", F.coalesce(F.size(F.filter("_bounds", lambda b: b < num)), F.lit(0)))
              .drop("_bounds"))
    w = Window.partitionBy(group, "_slice").orderBy(*order)
    w_all = Window.partitionBy(group, "_slice")
    local = sliced.select(
        "*", F.row_number().over(w).alias("_lrn"), F.count(F.lit(1)).over(w_all).alias("_lcnt"),
        *[F.lag(value, i).over(w).alias(f"_ll{i}") for i in range(1, n_lags + 1)])
    # one row per slice: size and its last n_lags values in order
    tail = F.when(F.col("_lrn") > F.col("_lcnt") - n_lags,
                  F.struct(F.col("_lrn").alias("p"), F.col(value).alias("v")))
    slices = local.groupBy(group, "_slice").agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.transform(F.sort_array(F.collect_list(tail)), lambda s: s["v"]).alias("_tail"))
    ws = Window.partitionBy(group).orderBy("_slice")
    carried = slices.select(
        group, "_slice",
        F.coalesce(F.sum("_cnt").over(ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.flatten(F.collect_list("_tail").over(ws.rowsBetween(-n_lags, -1))).alias("_carry"))
    carried = carried.withColumn(
        "_carry", F.slice("_carry", F.greatest(F.size("_carry") - n_lags + 1, F.lit(1)), n_lags))
    j = local.join(carried, [group, "_slice"])
    size = F.size("_carry")
    lags = []
    for i in range(1, n_lags + 1):
        # i positions back from a row at local position p: inside the slice when p > i,
        # else the (i - p + 1)-th value before the slice start = carry[size - (i - p)]
        idx = size - (F.lit(i) - F.col("_lrn"))
        from_carry = F.when(idx >= 1, F.try_element_at("_carry", idx.cast("int")))
        lags.append(F.when(F.col("_lrn") > i, F.col(f"_ll{i}")).otherwise(from_carry).alias(f"{lag_prefix}{i}"))
    return j.select(*df.columns, (F.col("_off") + F.col("_lrn")).cast("int").alias(seq_col), *lags)
