"""One-hot features of columns with any number of categories, as sparse vectors.

``fit_categories`` numbers a column's values in their order as text; the numbers are
a table, so categories are never listed on the driver (their count per column is).
``one_hot_sparse`` joins a row's numbers by value and hands them to Spark's one-hot
encoder: a row holds one index per column however many categories there are.  NULL
and values that the table lacks get no slot, so the table of the training rows
serves for scoring.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Dict, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.cumulative import global_index
from ledgerlens.session import materialize


@dataclass
class Categories:
    table: DataFrame          # column, value (as text), code from 0 on within the column
    sizes: Dict[str, int]     # categories per column

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str) -> "Categories":
        table = spark.read.parquet(path)
        return Categories(table, {r.column: r.n for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()})


def fit_categories(df: DataFrame, cols: Sequence[str]) -> Categories:
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
                      .alias("x")).select("x.*").where("value is not null").distinct().withColumn("_one", F.lit(0))
    placed = global_index(pairs, "_one", partition_cols=["column"], tiebreak=["value"])
    table = materialize(placed.select("column", "value", (F.col("pos") - 1).cast("long").alias("code")))
    sizes = {r.column: r.n for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Categories(table, {c: sizes.get(c, 0) for c in cols})


def one_hot_sparse(df: DataFrame, categories: Categories, out: str = "one_hot") -> DataFrame:
    """``df`` with a sparse vector ``out``: the columns' slots one after the other, in the order of ``sizes``."""
    spark, cols = df.sparkSession, [c for c, n in categories.sizes.items() if n]
    coded = df
    for i, c in enumerate(cols):
        table = categories.table.where(F.col("column") == c).select(F.col("value").alias(f"_v{i}"), F.col("code").alias(f"_c{i}"))
        none = float(categories.sizes[c])                    # the encoder's extra category, which it drops
        coded = (coded.join(table, F.col(c).cast("string") == F.col(f"_v{i}"), "left").drop(f"_v{i}")
                 .withColumn(f"_c{i}", F.coalesce(F.col(f"_c{i}").cast("double"), F.lit(none))))
    codes, parts = [f"_c{i}" for i in range(len(cols))], [f"_o{i}" for i in range(len(cols))]
    if not cols:
        raise ValueError("no column has a category")
    top = spark.createDataFrame([tuple(float(categories.sizes[c] - 1) for c in cols)], codes)
    encoder = OneHotEncoder(inputCols=codes, outputCols=parts, handleInvalid="keep", dropLast=True).fit(top)
    return VectorAssembler(inputCols=parts, outputCol=out).transform(encoder.transform(coded)).drop(*codes, *parts)


def slots(vector: str) -> F.Column:
    """The slots of a vector column that hold more than 0, ascending; a sparse vector is never written out in full."""
    v = F.unwrap_udt(F.col(vector))
    place = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))      # a dense vector has no indices
    held = F.filter(F.arrays_zip(place.alias("i"), v["values"].alias("x")), lambda e: e["x"] > 0)
    return F.transform(held, lambda e: e["i"])
