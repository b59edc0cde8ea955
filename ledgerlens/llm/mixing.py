"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets.

Main path: DataFrame operations only.

* Size of a document: its number of words ``[^\\x20\\x09-\\x0D]+`` (null text: 0).
* Sources are ranked by code point, null last, and weigh 1, 2, 3, repeating.
  Targets share the total size by weight; none exceeds ``max_epochs`` times its
  source, the excess being shared again by weight (the water level of
  ``source_targets``).
* Inside a source documents are ordered by a hash of their id.  With budget
  floor(target), floor(budget / size of the source) whole epochs are taken and
  the rest is cut off the order at the exact word: the document on the cut is
  taken in part.  So a source's words add up to floor(target), and no document
  gives more than ``max_epochs`` times its size.

Defined cases: null source is a source of its own; null id hashes like the empty
string; repeated rows and equal ids are ordered by size too, so reruns agree; a
source without words has target 0; an empty table gives an empty result.

Scale: texts are read once and never shuffled.  Rows of (id, source, size) are
range-partitioned by (source, hash), so a source holding a third of all rows
spans its share of partitions; offsets are one row per (partition, source).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import save

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def prefix_sums(df: DataFrame, group: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    """``df`` with the sum of each value over the rows before this one in (group, order).

    values: new column -> summed column.  Rows are dealt out by range over
    (group, order) and written with their partition number; sums run inside
    (partition, group) and are lifted by the sums of the group's earlier partitions.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    t = save(df.repartitionByRange(n, *group, *order).withColumn("_part", F.spark_partition_id()), "range")
    here = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = t.withColumns({new: F.coalesce(F.sum(v).over(here), F.lit(0)) for new, v in values.items()})
    # one row per (partition, group); without groups as many rows as partitions
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = t.groupBy("_part", *group).agg(*[F.sum(v).alias(f"_s_{new}") for new, v in values.items()])
    offsets = sums.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
                          *[F.coalesce(F.sum(f"_s_{new}").over(before), F.lit(0)).alias(f"_o_{new}")
                            for new in values])
    on = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        on &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return local.join(offsets, on).select(
        *df.columns, *[(F.col(new) + F.col(f"_o_{new}")).alias(new) for new in values])


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """(source, source_size, target) from rows (source, size).

    The targets are min(max_epochs * size, level * weight) for the one level at
    which they add up to the total.  With sources in order of
    max_epochs * size / weight, the level is what is left after the sources
    before, per remaining weight, at the first source that stays under its cap.
    """
    s = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
         .withColumn("no_source", F.col("source").isNull()).withColumn("one", F.lit(1).cast("long")))
    s = prefix_sums(s, [], ["no_source", "source"], {"place": "one"})
    nth = F.array(*[F.lit(w) for w in weights])
    s = s.withColumn("weight", F.element_at(nth, (F.col("place") % len(weights) + 1).cast("int")).cast("long"))
    s = s.withColumn("cap", F.col("source_size") * max_epochs).withColumn("ratio", F.col("cap") / F.col("weight"))
    s = prefix_sums(s, [], ["ratio", "no_source", "source"], {"caps": "cap", "before": "weight"})
    total = s.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()    # one row
    if total.t is None:
        return s.select("source", "source_size", F.lit(0.0).alias("target"))
    level = ((F.lit(total.t).cast("double") - F.col("caps").cast("double"))
             / (F.lit(total.w).cast("double") - F.col("before").cast("double")))
    s = s.withColumn("level", level)
    top = s.where("level <= ratio").agg(F.max("level")).first()[0] or 0.0                 # one number
    return s.select("source", "source_size",
                    F.least(F.col("cap").cast("double"), F.lit(float(top)) * F.col("weight")).alias("target"))


def mix_sources(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: str = "") -> DataFrame:
    """(id, source, size, source_size, target, taken) for every row of ``df``."""
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    rows = save(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                          n_words(text_col).alias("size"), key.alias("key")), "sizes")
    t = source_targets(rows, weights, max_epochs).select(F.col("source").alias("s"), "source_size", "target")
    placed = prefix_sums(rows, ["source"], ["key", "id", "size"], {"before": "size"})
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size") - F.col("before")
    return (placed.join(t, F.col("source").eqNullSafe(F.col("s")))
            .withColumn("epochs", epochs)
            .withColumn("taken", F.col("epochs") * F.col("size")
                        + F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest)))
            .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", "taken"))
