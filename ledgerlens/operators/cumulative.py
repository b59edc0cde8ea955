"""Running totals along an ordered key without a single-partition window.

A plain ``sum(..).over(Window.orderBy(k))`` moves every row into one task.
Here rows are dealt out by range over (partition columns, key, tiebreak) and
written once with their partition number.  Sums run inside (partition number,
partition columns) in parallel and are lifted by the sums of the same group's
earlier range partitions: one row per (range partition, group), summed by Spark.
A value or a group that holds most rows spans as many range partitions as its
share, because the tiebreak belongs to the range key; results do not depend on
the number of partitions.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def range_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def ranged(df: DataFrame, order_col: str, partition_cols: Sequence[str] = (), descending: bool = False,
           tiebreak: Sequence[str] = (), n_parts: int | None = None) -> DataFrame:
    """``df`` range-partitioned and written, with ``_rt_key`` (ascending) and ``_rt_p``."""
    from ledgerlens.session import materialize
    key = F.col(order_col).cast("double")
    keyed = df.withColumn("_rt_key", -key if descending else key)
    dealt = keyed.repartitionByRange(n_parts or range_parts(df), *partition_cols, "_rt_key", *tiebreak)
    return materialize(dealt.withColumn("_rt_p", F.spark_partition_id()))


def running_totals(df: DataFrame, order_col: str, sum_cols: Sequence[str],
                   partition_cols: Sequence[str] = (), descending: bool = False,
                   tiebreak: Sequence[str] = (), n_parts: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum of ``c``) for every ``c`` in ``sum_cols``.

    ``order_col`` must be numeric and, together with ``tiebreak`` (ascending),
    unique within ``partition_cols`` (NULL groups count as groups).  Rows are
    ordered ascending by ``order_col``, or descending when ``descending``.
    """
    parts = list(partition_cols)
    base = ranged(df, order_col, parts, descending, tiebreak, n_parts)
    inside = (Window.partitionBy("_rt_p", *parts).orderBy("_rt_key", *tiebreak)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = base.withColumns({f"_rt_in_{c}": F.sum(c).over(inside) for c in sum_cols})
    earlier = Window.partitionBy(*parts).orderBy("_rt_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = base.groupBy("_rt_p", *parts).agg(*[F.sum(c).alias(f"_rt_t_{c}") for c in sum_cols])
    offsets = sums.select(F.col("_rt_p").alias("_rt_op"), *[F.col(p).alias(f"_rt_g{i}") for i, p in enumerate(parts)],
                          *[F.coalesce(F.sum(f"_rt_t_{c}").over(earlier), F.lit(0)).alias(f"_rt_o_{c}")
                            for c in sum_cols])
    on = F.col("_rt_p") == F.col("_rt_op")
    for i, p in enumerate(parts):
        on &= F.col(p).eqNullSafe(F.col(f"_rt_g{i}"))
    out = inner.join(offsets, on)
    return out.select(*df.columns, *[(F.col(f"_rt_in_{c}") + F.col(f"_rt_o_{c}")).alias(f"cum_{c}") for c in sum_cols])


def global_index(df: DataFrame, order_col: str, descending: bool = False,
                 partition_cols: Sequence[str] = (), tiebreak: Sequence[str] = (),
                 n_parts: int | None = None) -> DataFrame:
    """1-based position of each row along (``order_col``, ``tiebreak``) within partitions."""
    one = df.withColumn("_gi_one", F.lit(1))
    out = running_totals(one, order_col, ["_gi_one"], partition_cols, descending, tiebreak, n_parts)
    return out.withColumnRenamed("cum__gi_one", "pos").drop("_gi_one")
