"""Payment histories kept apart from the products: stored by key, joined in place.

``store_history`` writes the history once, bucketed and sorted by ``(id, rn)``.
``join_history`` sends the products to the buckets of that table; the history itself
does not move again, however many product tables are joined to it.  A key that
several history rows claim would multiply products: the row that comes last in the
order of all its columns is used, and ``alignment_report`` counts such keys, products
without a history and histories without a product.
"""

from __future__ import annotations

from typing import Optional, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.sequence import order_paym_cols

KEYS = ("id", "rn")


def store_history(history: DataFrame, table: str, path: str, keys: Sequence[str] = KEYS, buckets: Optional[int] = None) -> str:
    """Write keys and history columns of ``history`` as the bucketed table ``table`` under ``path``.

    ``buckets`` must not be below the session's shuffle partitions, or Spark moves both sides of a join.
    """
    spark = history.sparkSession
    n = max(buckets or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cols = [*keys, *order_paym_cols(history.columns)]
    (history.select(*cols).repartition(n, *keys).write.mode("overwrite").option("path", path)
     .bucketBy(n, *keys).sortBy(*keys).saveAsTable(table))
    return table


def unique_history(spark: SparkSession, table: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """The stored history with one row per key; grouped where it lies."""
    rows = spark.table(table)
    paym = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max(F.struct(*paym)).alias("_h"))
    return best.select(*keys, *[F.col(f"_h.{c}").alias(c) for c in paym])


def join_history(products: DataFrame, table: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """``products`` with the stored history of their key (NULL statuses where there is none).

    History columns of ``products`` itself give way to the stored ones.
    """
    history = unique_history(products.sparkSession, table, keys)
    own = [c for c in products.columns if c in keys or c not in history.columns]
    return products.select(*own).join(history.hint("merge"), list(keys), "left")


def alignment_report(products: DataFrame, table: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row: products, histories, repeated_keys, products_without_history, histories_without_product."""
    spark = products.sparkSession
    # a side's rows per key, both in the buckets of the stored table
    p = products.groupBy(*keys).agg(F.count(F.lit(1)).alias("np"))
    h = spark.table(table).groupBy(*keys).agg(F.count(F.lit(1)).alias("nh"))
    both = p.join(h, list(keys), "full_outer")
    none = F.lit(0).cast("long")
    return both.agg(F.coalesce(F.sum("np"), none).alias("products"), F.coalesce(F.sum("nh"), none).alias("histories"),
                    F.count_if(F.col("nh") > 1).alias("repeated_keys"),
                    F.coalesce(F.sum(F.when(F.col("nh").isNull(), F.col("np"))), none).alias("products_without_history"),
                    F.coalesce(F.sum(F.when(F.col("np").isNull(), F.col("nh"))), none).alias("histories_without_product"))
