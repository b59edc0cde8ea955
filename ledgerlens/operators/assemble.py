"""Keys, latest record per borrower, label joins and set operations."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Optional, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.config import TIE_BREAK_COLS
from ledgerlens.operators.cumulative import range_parts


def _order_key(df: DataFrame, order: Sequence[str], secondary: Iterable[str],
               tiebreak: Sequence[str]) -> F.Column:
    """Sort key where larger wins; a NULL secondary key beats any value."""
    fields = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    for j, c in enumerate(s for s in secondary if s in df.columns):
        fields += [F.col(c).isNull().alias(f"n{j}"), F.col(c).alias(f"s{j}")]
    fields += [F.col(c).alias(f"t{i}") for i, c in enumerate(tiebreak)]
    return F.struct(*fields)


def _match(left: DataFrame, right: DataFrame, cols: Sequence[str], how: str) -> DataFrame:
    """Join on equal ``cols``, NULL matching NULL, keeping the left columns."""
    names = {c: f"_m{i}" for i, c in enumerate(cols)}
    r = right.select(*[F.col(c).alias(x) for c, x in names.items()])
    on = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(x)) for c, x in names.items()])
    return left.join(r, on, how)


def _even(df: DataFrame, group: Sequence[str]) -> bool:
    """Whether no group has more rows than a task's fair share (one aggregate over the keys)."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_c")).agg(F.max("_c").alias("most"), F.sum("_c").alias("all")).first()
    return (sizes["most"] or 0) <= max(1, -(-(sizes["all"] or 0) // range_parts(df)))


def keep_max(df: DataFrame, group: Sequence[str], order: Sequence[str],
             secondary: Iterable[str] = TIE_BREAK_COLS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """One row per ``group``: the row with the largest (order, secondary, tiebreak, row).

    Where no group has more than a fair share of the rows, the largest ``order`` value and
    the number of rows that tie on it come from windows per group: whole rows move once, and
    not at all where ``df`` is numbered per group already.  Otherwise they are hash aggregates
    over the keys alone, and whole rows are matched to them by joins on (group, order), which
    a hot group does not skew.  Only rows that tie on ``order`` are compared as whole rows:
    ``max(struct(key, row))`` with its map-side partial step closes ties deterministically.
    """
    from ledgerlens.session import materialize
    if _even(df, group):
        each = Window.partitionBy(*group)
        left = df
        if order:
            left = df.withColumn("_top", F.max(order[0]).over(each)).filter(F.col(order[0]).eqNullSafe(F.col("_top"))).drop("_top")
        left = materialize(left.withColumn("_rows", F.count(F.lit(1)).over(each)))
        alone, tied = left.filter("_rows = 1").drop("_rows"), left.filter("_rows > 1").drop("_rows")
    else:
        left = df
        if order:
            top = df.groupBy(*group).agg(*[F.max(c).alias(c) for c in order[:1]])
            left = _match(df, top, [*group, *order[:1]], "left_semi")
        left = materialize(left)
        several = left.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
        alone = _match(left, several, group, "left_anti")
        tied = _match(left, several, group, "left_semi")
    payload = [c for c in df.columns if c not in group]
    key = _order_key(df, order, secondary, tiebreak)
    best = tied.groupBy(*group).agg(
        F.max(F.struct(key.alias("k"), F.struct(*payload).alias("r"))).alias("_best"))
    closed = best.select(*[F.col(g) for g in group], *[F.col(f"_best.r.{c}").alias(c) for c in payload])
    return alone.unionByName(closed.select(*df.columns))


def latest_record(df: DataFrame, key: str = "id", order: str = "rn",
                  secondary: Iterable[str] = TIE_BREAK_COLS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest product per borrower: max ``rn`` (NULL rn dropped), ties by the secondary keys."""
    return keep_max(df.filter(F.col(order).isNotNull()), [key], [order], secondary, tiebreak)


def dedupe_keep_last(df: DataFrame, keys: Sequence[str] = ("id", "rn"),
                     secondary: Iterable[str] = TIE_BREAK_COLS, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Drop duplicate keys keeping the row that sorts last on the secondary keys."""
    return keep_max(df, list(keys), [], secondary, tiebreak)


def max_rn_by_id(df: DataFrame, key: str = "id", order: str = "rn") -> DataFrame:
    return df.groupBy(key).agg(F.max(order).alias(f"max_{order}"))


def filter_equals_latest(df: DataFrame, key: str = "id", order: str = "rn") -> DataFrame:
    """Rows whose ``rn`` equals the borrower's max (semi join on (id, rn); no skew on a hot id)."""
    mx = max_rn_by_id(df, key, order).withColumnRenamed(f"max_{order}", order)
    return df.join(mx, [key, order], "left_semi")


def dedupe_labels(labels: DataFrame, key: str = "id", label: str = "flag") -> DataFrame:
    """One label per id; duplicated ids keep the largest flag (a default anywhere counts)."""
    return labels.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(label).alias(label))


def join_labels_left(df: DataFrame, labels: DataFrame, key: str = "id", label: str = "flag",
                     target: str = "target") -> DataFrame:
    """Left join of the label; unlabelled rows stay with a NULL target.

    No broadcast hint: the label table grows with the borrower count, so the
    runtime size check of adaptive execution decides between broadcast and
    shuffle join.
    """
    lab = dedupe_labels(labels, key, label).select(
        F.col(key), F.col(label).cast("tinyint").alias(target))
    cols = [c for c in df.columns if c != target]
    return df.select(*cols).join(lab, key, "left")


def label_gap(df: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    """Borrowers without a label (anti join)."""
    return df.select(key).distinct().join(labels.select(key), key, "left_anti")


def intersect_ids(df: DataFrame, labels: DataFrame, key: str = "id") -> DataFrame:
    return df.select(key).intersect(labels.select(key))


def union_shards(frames: Sequence[DataFrame], key: str = "id") -> DataFrame:
    """Concatenate frames by name; a column missing in a frame comes as typed NULL."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    rest = [c for c in out.columns if c != key]
    return out.select(key, *rest) if key in out.columns else out


def filter_labelled(df: DataFrame, target: str = "target") -> DataFrame:
    return df.filter(F.col(target).isNotNull())


DIFF_BUCKETS = 4096


def bucket_prints(df: DataFrame, keys: Sequence[str], cols: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, rows, xor, sum): an order-free fingerprint of the rows in every bucket of keys."""
    # NULLs are hashed by a flag of their own; the sum tells apart what an even number of equal rows hides in the xor
    h = F.xxhash64(*[F.col(c) for c in [*keys, *cols]], *[F.col(c).isNull() for c in [*keys, *cols]])
    return df.select(_bucket(keys, buckets).alias("bucket"), h.alias("h")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.bit_xor("h").alias("xor"), F.sum(F.col("h").cast("decimal(20,0)")).alias("sum"))


def _bucket(keys: Sequence[str], buckets: int) -> F.Column:
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _numbered(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``df`` with ``_nth``, the place among rows of equal keys; only rows of repeated keys are moved for it."""
    several = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.xxhash64(*cols)))
    return (_match(df, several, keys, "left_anti").withColumn("_nth", F.lit(1))
            .unionByName(_match(df, several, keys, "left_semi").withColumn("_nth", place)))


def dataset_diff(a: DataFrame, b: DataFrame, keys: Sequence[str] = ("id", "rn"),
                 ignore: Optional[Sequence[str]] = None, buckets: int = DIFF_BUCKETS) -> DataFrame:
    """Column and row differences between two versions of a table.

    Rows ``(section, name, value)``: ``column_removed`` / ``column_added`` /
    ``column_common`` per column, ``rows`` counts (``removed``, ``added``,
    ``common``) and ``changed`` = common rows whose value differs per common
    column (NULL-safe).

    Either side is cut into ``buckets`` by a hash of its keys and fingerprinted, one
    aggregate each; buckets with equal fingerprints are common as they are.  Only
    the rows of the others are joined on their keys.
    """
    spark = a.sparkSession
    ignore = set(ignore or ())
    ca = [c for c in a.columns if c not in keys and c not in ignore]
    cb = [c for c in b.columns if c not in keys and c not in ignore]
    common = [c for c in ca if c in cb]
    meta = ([("column_removed", c) for c in ca if c not in cb]
            + [("column_added", c) for c in cb if c not in ca]
            + [("column_common", c) for c in common])
    meta_df = spark.createDataFrame(meta, "section string, name string").withColumn(
        "value", F.lit(None).cast("bigint"))
    pa, pb = bucket_prints(a, keys, common, buckets), bucket_prints(b, keys, common, buckets)
    names = ["rows", "xor", "sum"]
    both_prints = pa.join(pb.select("bucket", *[F.col(c).alias(f"{c}_b") for c in names]), "bucket", "full_outer").collect()
    equal = {r.bucket: r.rows for r in both_prints if all(r[c] is not None and r[c] == r[f"{c}_b"] for c in names)}
    differ = [r.bucket for r in both_prints if r.bucket not in equal]                # at most ``buckets`` numbers
    same = sum(equal.values())
    if not differ:
        counts = [("rows", "removed", 0), ("rows", "added", 0), ("rows", "common", same), *[("changed", c, 0) for c in common]]
        return meta_df.unionByName(spark.createDataFrame(counts, "section string, name string, value bigint"))
    if equal:
        wanted = set(differ)
        flags = F.split(F.lit(",".join("true" if k in wanted else "false" for k in range(buckets))), ",").cast("array<boolean>")
        a, b = (t.where(F.element_at(flags, _bucket(keys, buckets) + 1)) for t in (a, b))
    a, b = _numbered(a, keys, common or keys), _numbered(b, keys, common or keys)
    keys = [*keys, "_nth"]
    la = a.select(*keys, F.lit(True).alias("_in_a"), *[F.col(c).alias(f"a__{c}") for c in common])
    lb = b.select(*[F.col(k).alias(f"_b{k}") for k in keys], F.lit(True).alias("_in_b"), *[F.col(c).alias(f"b__{c}") for c in common])
    j = la.join(lb, reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_b{k}")) for k in keys]), "full_outer")
    both = F.col("_in_a") & F.col("_in_b")
    aggs = [F.sum(F.when(F.col("_in_a") & F.col("_in_b").isNull(), 1).otherwise(0)).alias("removed"),
            F.sum(F.when(F.col("_in_b") & F.col("_in_a").isNull(), 1).otherwise(0)).alias("added"),
            (F.sum(F.when(both, 1).otherwise(0)) + F.lit(same)).alias("common")]
    aggs += [F.sum(F.when(both & ~F.col(f"a__{c}").eqNullSafe(F.col(f"b__{c}")), 1).otherwise(0))
             .alias(f"chg__{c}") for c in common]
    row = j.agg(*aggs)
    stacked = row.select(F.explode(F.array(
        *[F.struct(F.lit("rows").alias("section"), F.lit(n).alias("name"), F.col(n).cast("bigint").alias("value"))
          for n in ("removed", "added", "common")],
        *[F.struct(F.lit("changed").alias("section"), F.lit(c).alias("name"),
                   F.col(f"chg__{c}").cast("bigint").alias("value")) for c in common])).alias("x")
    ).select("x.section", "x.name", "x.value")
    return meta_df.unionByName(stacked)
