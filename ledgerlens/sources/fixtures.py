"""Domain-shaped inputs derived from the driver's TPC-H-like tables.

``credit_products``: one product row per order with a ragged 25-slot payment
history (the customer's earlier orders); ``paym_events``: one row per user with
a dense history from the event stream; ``labels_credit``: default flags per
customer; ``scored``: a deterministic score per labelled product row.
All are plain DataFrame plans, so Catalyst prunes whatever a consumer does not
read.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.operators.sequencing import numbered_history

N_SLOTS = 25
PAYM_COLS = tuple(f"enc_paym_{i}" for i in range(N_SLOTS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _month_index(c):
    """Months before 2002-01: (2002 - year) * 12 - month."""
    return (F.lit(2002) - F.year(c)) * 12 - F.month(c)


def lineitem_rollup(lineitem: DataFrame) -> DataFrame:
    """Per order amounts, delinquency buckets and a 0..9 status code (partial + final agg)."""
    price = F.floor("l_extendedprice")
    returned = F.col("l_returnflag") == "R"
    disc = F.round(F.col("l_discount") * 100)

    def bucket(cond):
        return F.sum(F.when(cond, 1).otherwise(0)).cast("int")

    return lineitem.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_linestatus") == "O", price).otherwise(0)).cast("int").alias("outstanding"),
        F.sum(F.when(returned, price).otherwise(0)).cast("int").alias("overdue"),
        F.max(F.when(returned, price).otherwise(0)).cast("int").alias("max_overdue"),
        F.min(price).cast("int").alias("next_pay"),
        bucket(disc.isin(1, 2)).alias("b5"),
        bucket(disc.isin(3, 4)).alias("b530"),
        bucket(disc.isin(5, 6)).alias("b3060"),
        bucket(disc.isin(7, 8)).alias("b6090"),
        bucket(disc >= 9).alias("b90"),
        F.greatest(F.round(F.max("l_tax") * 100) - 4, F.lit(0)).cast("int").alias("code"),
        F.max(_month_index(F.col("l_shipdate"))).alias("confirmed"),
    )


def credit_products(spark: SparkSession, sf_dir: str, n_slots: int = N_SLOTS) -> DataFrame:
    """One product row per order; ``rn`` = the order's position in the customer's
    history, ``enc_paym_i`` = status code of the order ``i`` positions earlier.

    Numbering and lags come from ``numbered_history`` (range-partitioned slices),
    so a customer with a huge share of all orders is never handled by one task.
    """
    # narrow types before any row moves; numbered by ``id`` itself, so what follows per id finds its rows together
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("id"), "o_orderdate",
        F.floor("o_totalprice").cast("int").alias("limit"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("type"),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("status"))
    li = lineitem_rollup(table(spark, sf_dir, "lineitem"))
    p = orders.join(li, orders.o_orderkey == li.l_orderkey, "left").drop("l_orderkey")
    h = numbered_history(p, "id", ["o_orderdate", "o_orderkey"], "code", n_slots - 1,
                         seq_col="_seq", lag_prefix="_lag", sizes_from=orders)
    zero = lambda c: F.when(F.col(c) == 0, 1).otherwise(0)
    cols = [
        F.col("id"),
        F.col("_seq").alias("rn"),
        (F.year("o_orderdate") - 1994).cast("int").alias("rn_dup"),
        F.col("o_orderkey"),
        F.col("limit").alias("pre_loans_credit_limit"),
        F.col("outstanding").alias("pre_loans_outstanding"),
        F.col("overdue").alias("pre_loans_total_overdue"),
        F.col("max_overdue").alias("pre_loans_max_overdue_sum"),
        F.col("next_pay").alias("pre_loans_next_pay_summ"),
        F.col("b5").alias("pre_loans5"),
        F.col("b530").alias("pre_loans530"),
        F.col("b3060").alias("pre_loans3060"),
        F.col("b6090").alias("pre_loans6090"),
        F.col("b90").alias("pre_loans90"),
        zero("b3060").alias("is_zero_loans3060"),
        zero("b6090").alias("is_zero_loans6090"),
        zero("b90").alias("is_zero_loans90"),
        _month_index(F.col("o_orderdate")).cast("int").alias("pre_since_opened"),
        F.col("confirmed").cast("int").alias("pre_since_confirmed"),
        F.col("type").alias("enc_loans_credit_type"),
        F.col("status").alias("enc_loans_credit_status"),
        F.col("code").alias("enc_paym_0"),
    ]
    cols += [F.col(f"_lag{i}").alias(f"enc_paym_{i}") for i in range(1, n_slots)]
    return h.select(*cols)


EVENT_CODES = (("view", 0), ("click", 1), ("purchase", 2), ("signup", 3))  # else 4


def paym_events(spark: SparkSession, sf_dir: str, n_slots: int = N_SLOTS) -> DataFrame:
    """Dense history: slot i = code of the i-th most recent event of the user.

    ``row_number() <= n`` lets Spark insert a per-partition group limit before the
    shuffle, so a very active user ships at most ``n`` rows per map task.
    """
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    code = F.lit(4)
    for name, v in reversed(EVENT_CODES):
        code = F.when(F.col("event_type") == name, v).otherwise(code)
    w = Window.partitionBy("user_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    e = (ev.withColumn("code", code)
         .withColumn("pos", F.row_number().over(w))
         .filter(F.col("pos") <= n_slots))
    return e.groupBy("user_id").agg(
        *[F.max(F.when(F.col("pos") == i + 1, F.col("code"))).alias(f"enc_paym_{i}")
          for i in range(n_slots)]
    ).select(F.col("user_id").cast("string").alias("id"), F.lit(1).alias("rn"),
             *[f"enc_paym_{i}" for i in range(n_slots)])


def labels_credit(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    return c.filter(F.col("c_nationkey") != 0).select(
        F.col("c_custkey").cast("string").alias("id"),
        F.when(F.col("c_acctbal") < 0, 1).otherwise(0).alias("flag"))


def scored(spark: SparkSession, sf_dir: str, products: DataFrame | None = None) -> DataFrame:
    """Labelled product rows with a tied, deterministic score in [0, ~1]."""
    products = products if products is not None else credit_products(spark, sf_dir)
    p = products.select("id", "rn", "pre_loans_outstanding", "pre_loans_credit_limit")
    lab = labels_credit(spark, sf_dir)
    score = F.floor(F.try_divide(F.coalesce(F.col("pre_loans_outstanding"), F.lit(0)) * 100,
                                 F.col("pre_loans_credit_limit"))) / 100
    return p.join(lab, "id").select(
        "id", "rn", F.col("flag").alias("target"), score.cast("double").alias("pred_proba"))
