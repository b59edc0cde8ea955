"""Merkle manifest of a dataset: a hash tree per group, the groups' roots in a tree of their own.

Nodes are lower-case hex SHA-256 digests.  A row's leaf digests its fields, each as
``-`` if null, else its UTF-8 byte count, ``:`` and its value, so no two rows of
different fields share an encoding.  Leaves of a group ascend by id.

Slot pivot: a node's place divided by ``fanout`` is its parent, the remainder its
slot.  Conditional aggregates spread the children of a parent into the columns
c0, c1, ...; hashing their concatenation gives the parent, and the concatenations
left and right of a slot's own column are the siblings its proof needs.  Paths are
handed down from the root, one join per level on the parent's key, and the rows of
the lowest level spread into the proofs of their leaves without another join.

Defined cases: null group is a group of its own, before the others; rows without
id come first in their group, equal ids by leaf; a group of one row has its leaf as
root; one group's root is the dataset's root; runs of one node are still hashed; an
empty table gives no rows; columns outside id, group and fields are not read.

Scale: only digests are shuffled, and each level has one ``fanout``-th of the rows
of the one below, written to the shared folder.  Parents hold ``fanout`` children
whatever the group, so a group with most of the rows is spread like any other.
Places come from prefix sums over range partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import save
from ledgerlens.llm.mixing import prefix_sums

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenation, nulls left out."""
    return F.sha2(F.concat_ws("", *parts).cast("binary"), 256)


def leaf_digest(fields: tuple[str, ...] = FIELDS, changed: dict[str, Column] | None = None) -> Column:
    """Digest of a row's fields; ``changed`` gives other values for some of them."""
    def encoded(name: str) -> Column:
        v = (changed or {}).get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))
    return digest(*[encoded(n) for n in fields])


@dataclass
class Manifest:
    """Written tables of a tree.

    levels    per level, bottom first: g, n (children in the group), pos, c0.. (children), node;
              the first also holds the rows' ids i0.. and presented leaves p0..
    single    g, id, leaf, presented of groups of one row
    groups    g, the group's value, subroot, and the group's path to the root
    root      None for an empty table
    """
    levels: list[DataFrame]
    single: DataFrame
    groups: DataFrame
    root: str | None
    fanout: int


def _level(nodes: DataFrame, fanout: int, spread: dict[str, str]) -> DataFrame:
    """One row per parent of the groups with more than one node; spread: slot prefix -> column."""
    slot = F.col("pos") % fanout
    cols = [F.max(F.when(slot == i, F.col(c))).alias(f"{p}{i}") for p, c in spread.items() for i in range(fanout)]
    up = (nodes.where("n > 1")
          .groupBy("g", "n", F.expr(f"pos div {fanout}").alias("pos")).agg(*cols))
    return up.withColumn("node", digest(*[F.col(f"c{i}") for i in range(fanout)]))


def _next(level: DataFrame, fanout: int) -> DataFrame:
    return level.select("g", F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), "pos", "node")


def _tree(nodes: DataFrame, most: int, fanout: int, spread: dict[str, str], tag: str) -> tuple[list[DataFrame], DataFrame]:
    """(levels, roots (g, node)) of rows (g, n, pos, node); ``most`` is the largest n."""
    levels, roots = [], [nodes.where("n = 1").select("g", "node")]
    while most > 1:
        levels.append(save(_level(nodes, fanout, spread), f"{tag}{len(levels)}"))
        spread = {"c": "node"}
        nodes = _next(levels[-1], fanout)
        roots.append(nodes.where("n = 1").select("g", "node"))
        most = -(-most // fanout)
    return levels, reduce(DataFrame.unionByName, roots)


def _slots(fanout: int, make) -> Column:
    """Rows for the slots that hold a child: make(i, siblings) gives a struct's columns."""
    def sides(i: int) -> Column:
        part = lambda js: F.concat_ws("", *[F.col(f"c{j}") for j in js])
        return F.struct(part(range(i)).alias("before"), part(range(i + 1, fanout)).alias("after"))
    each = F.array(*[F.when(F.col(f"c{i}").isNotNull(), F.struct(*make(i, sides(i)))) for i in range(fanout)])
    return F.inline(F.filter(each, lambda x: x.isNotNull()))


def _paths(levels: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """The rows of the lowest level with ``path``, that of their own node, and ``subroot``.

    tops: (g, subroot, path) of the roots.
    """
    up, rows = None, None
    for level in reversed(levels):
        rows = level.where(F.col("n") <= fanout).join(tops, "g")             # the root of its group
        if up is not None:
            rows = rows.unionByName(level.where(F.col("n") > fanout).join(up, ["g", "pos"]))
        up = rows.select("g", "subroot", _slots(fanout, lambda i, s: [
            (F.col("pos") * fanout + i).alias("pos"), F.concat(F.array(s), "path").alias("path")]))
    return rows


def build(df: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
          presented: Column | None = None, fanout: int = 8) -> Manifest:
    """The tree of all rows.  ``presented``: leaf digest to check later in place of a row's own."""
    leaf = leaf_digest(fields)
    rows = save(df.select(F.col(group_col).alias("grp"), F.col(id_col).alias("id"), leaf.alias("leaf"),
                          (leaf if presented is None else presented).alias("presented"))
                .withColumns({"one": F.lit(1).cast("long"), "row": F.monotonically_increasing_id()}), "leaves")
    groups = rows.groupBy("grp").agg(F.count("*").alias("n"), F.first("one").alias("one"))
    groups = save(prefix_sums(groups, [], ["grp"], {"g": "one"}).select("g", "grp", "n"), "groups")
    most, count = groups.agg(F.max("n"), F.count("*")).first()
    placed = prefix_sums(rows, ["grp"], ["id", "leaf", "presented", "row"], {"pos": "one"})
    at = groups.select("g", "n", F.col("grp").alias("grp_"))
    nodes = placed.join(at, F.col("grp").eqNullSafe(F.col("grp_"))).select(
        "g", "n", "pos", "id", F.col("leaf").alias("node"), "presented")
    levels, roots = _tree(nodes, most or 0, fanout, {"c": "node", "p": "presented", "i": "id"}, "level")
    single = nodes.where("n = 1").select("g", "id", F.col("node").alias("leaf"), "presented")
    roots = save(roots.select("g", F.col("node").alias("subroot")), "subroots")
    # the groups' roots, in the groups' order, are the leaves of the upper tree
    upper = roots.select(F.lit(0).cast("long").alias("g"), F.lit(count).cast("long").alias("n"),
                         F.col("g").alias("pos"), F.col("subroot").alias("node"))
    upper_levels, top = _tree(upper, count, fanout, {"c": "node"}, "upper")
    none = F.array().cast(PATH)
    if not upper_levels:                                       # at most one group
        paths = roots.select("g", "subroot", none.alias("path"))
    else:
        low = _paths(upper_levels, top.select("g", F.col("node").alias("subroot"), none.alias("path")), fanout)
        paths = low.select(_slots(fanout, lambda i, s: [
            (F.col("pos") * fanout + i).alias("g"), F.col(f"c{i}").alias("subroot"),
            F.concat(F.array(s), "path").alias("path")]))
    first = top.first()                                        # one row, or none
    paths = save(paths.join(groups.select("g", "grp"), "g"), "tops")
    return Manifest(levels, single, paths, first.node if first else None, fanout)


def prove(m: Manifest, id_col: str = "doc_id") -> DataFrame:
    """Every row's proof, and the root recomputed from its presented leaf.

    (id, leaf, subroot, root, proof_sha256, folded_root, verified): proof_sha256
    digests the siblings, bottom level first and left to right.
    """
    tops = m.groups.select("g", "subroot", "path")
    out = m.single.join(tops, "g").select("id", "leaf", "presented", "subroot", "path")
    if m.levels:
        low = _paths(m.levels, tops, m.fanout)
        out = out.unionByName(low.select("subroot", _slots(m.fanout, lambda i, s: [
            F.col(f"i{i}").alias("id"), F.col(f"c{i}").alias("leaf"), F.col(f"p{i}").alias("presented"),
            F.concat(F.array(s), "path").alias("path")])))
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x.before, x.after)), "")
    fold = F.aggregate("path", F.col("presented"), lambda a, x: digest(x.before, a, x.after))
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", F.lit(m.root).alias("root"),
                      digest(siblings).alias("proof_sha256"), fold.alias("folded_root")
                      ).withColumn("verified", F.col("folded_root") == F.col("root"))


def verify_against(df: DataFrame, other: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """Rows of ``other`` (unique ids) checked against the manifest of ``df``: ids with a verdict.

    Rows of ``df`` whose id ``other`` lacks are presented as missing (null digest, not verified).
    """
    fields = how.get("fields", FIELDS)
    theirs = other.select(F.col(id_col).alias("_id"), leaf_digest(fields).alias("_leaf"))
    both = df.join(theirs, F.col(id_col) == F.col("_id"), "left")
    out = prove(build(both, id_col, presented=F.col("_leaf"), **how), id_col)
    return out.select(id_col, F.coalesce("verified", F.lit(False)).alias("verified"))
