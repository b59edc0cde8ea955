"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per dimension, set where the value is above 0.  Codes
are cut into segments; ``index`` maps (segment, value) to codes.  Round r looks up,
for every unfinished query, all values at exactly r bits from its own in every
segment.  A code is taken where its first closest segment meets the query, so it
comes up once in all.  After round r every code within
``segments * (r + 1) - 1`` bits has come up; a query ends when its kth distance lies
within that.  Codes farther than a query's kth distance so far are dropped in the join,
and segments that cannot bring a nearer one are not looked up.  No join is a broadcast:
only the number of unfinished queries reaches the driver.

Equal codes are one entry that keeps its ``k + 1`` smallest ids (no more can be
among the k nearest of anything), so copies of a vector, however many, cost one.
Queries with equal codes are one search.

Segments hold about log2(number of codes) bits, as the method wants it; this sets
the speed alone.  Defined cases: null vectors (and null ids) take no part; null
elements count as 0; ties go to the smaller id; with repeated ids, the same id
may come twice; a query's own id is not among its neighbours; fewer than k others
give fewer rows; empty tables give none.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import drop_saved, save

WORD = 64        # bits kept in one long of a code


def codes(df: DataFrame, id_col: str, vec_col: str, dims: int) -> DataFrame:
    """(id, code): the sign bits in longs of ``WORD`` bits."""
    words = []
    for a in range(0, dims, WORD):
        bits = [f"case when get(v, {i}) > 0 then shiftleft(1L, {i - a}) else 0L end"
                for i in range(a, min(dims, a + WORD))]
        words.append("(" + " | ".join(bits) + ")")
    return (df.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull())
            .select(F.col(id_col).alias("id"), F.col(vec_col).alias("v"))
            .select("id", F.expr(f"array({', '.join(words)})").alias("code")))


def segment_exprs(dims: int, bits: int) -> list[tuple[str, int]]:
    """The value of each segment of the code and its number of bits; segments stay inside a long and are even."""
    out = []
    for w, a in enumerate(range(0, dims, WORD)):
        n = min(WORD, dims - a)
        parts = -(-n // bits)
        cuts = [n * s // parts for s in range(parts + 1)]
        out += [(f"(shiftrightunsigned(get(code, {w}), {x}) & {(1 << (z - x)) - 1}L)", z - x)
                for x, z in zip(cuts, cuts[1:])]
    return out


def distance(a: str, b: str, n: int) -> str:
    return " + ".join(f"bit_count(get({a}, {i}) ^ get({b}, {i}))" for i in range(n))


def probes(open_q: DataFrame, parts: list[tuple[str, int]], r: int) -> DataFrame:
    """(q, bound, seg, value): every value at ``r`` bits from the query's own, per segment.

    A code that no earlier round met has at least r differing bits in each of the m segments.  Within
    ``bound`` = m r + b bits, m - b or more of its segments have exactly r, one of them among the first b + 1.
    """
    near = []
    for s, (e, width) in enumerate(parts):
        if r <= width:
            masks = ",".join(str(sum(1 << i for i in c)) for c in combinations(range(width), r))
            # one text literal: a literal per mask costs the driver's parser some KB each
            each = (f"transform(cast(split('{masks}', ',') as array<bigint>), m -> struct({s} as seg, "
                    f"({e.replace('code', 'q')} ^ m) as value))")
            near.append(f"case when bound >= {len(parts) * r + s} then {each} else array() end")
    return (open_q.select("q", "bound", F.explode(F.expr(f"flatten(array({', '.join(near)}))")).alias("x"))
            .select("q", "bound", "x.seg", "x.value"))


def meet(asked: DataFrame, index: DataFrame, parts: list[tuple[str, int]], n_words: int) -> DataFrame:
    """(q, code, distance) of the codes that probes meet, each in its first closest segment and within the bound.

    Both sides are shuffled: Spark's estimate of the probes leaves out how many rows a query
    explodes into, so it would build them all on the driver for a broadcast.
    """
    far = [f"bit_count({e.replace('code', 'q')} ^ {e})" for e, _ in parts]
    first = F.expr("case " + " ".join(
        f"when {d} = least({', '.join(far)}, 999) then {s}" for s, d in enumerate(far)) + " end")
    return (asked.hint("merge").join(index, ["seg", "value"])
            .where((first == F.col("seg")) & (F.expr(distance("q", "code", n_words)) <= F.col("bound")))
            .select("q", "code", F.expr(distance("q", "code", n_words)).alias("distance")))


def top_k(df: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
          dims: int | None = None, segment_bits: int | None = None) -> DataFrame:
    """(query_id, rank, neighbour_id, distance): the k nearest of ``df`` for each row of ``queries``."""
    if dims is None:
        dims = df.where(F.col(vec_col).isNotNull()).agg(F.max(F.size(vec_col))).first()[0] or 1
    spark, n_words = df.sparkSession, -(-dims // WORD)
    every = (codes(df, id_col, vec_col, dims).groupBy("code", "id").count()
             .withColumn("n", F.row_number().over(Window.partitionBy("code").orderBy("id")))
             .where(F.col("n") <= k + 1))
    base = save(every.groupBy("code").agg(F.sort_array(F.collect_list(
        F.struct("id", F.least("count", F.lit(k + 1)).alias("copies")))).alias("ids")), "codes")
    asked = save(codes(queries, id_col, vec_col, dims), "asked")
    n_codes = base.count()
    bits = segment_bits or min(16, max(4, n_codes.bit_length() - 1))
    parts = segment_exprs(dims, bits)
    # dealt by value, so that it comes back in as many parts as there are tasks to probe it
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    index = save(base.select("code", F.explode(F.array(*[
        F.struct(F.lit(s).alias("seg"), F.expr(e).alias("value")) for s, (e, _) in enumerate(parts)])).alias("x"))
        .select("x.seg", "x.value", "code").repartition(n_tasks, "seg", "value"), "index")
    # bound: distance beyond which a code is no use to the query any more
    open_q = save(asked.select(F.col("code").alias("q")).distinct().withColumn("bound", F.lit(WORD * n_words)), "open")
    best = None
    most = max(b for _, b in parts)
    for r in range(most + 1):
        met = meet(probes(open_q.repartition(n_tasks, "q"), parts, r), index, parts, n_words)
        # k + 1 codes hold k rows besides the query itself
        ranked = Window.partitionBy("q").orderBy("distance", F.element_at("ids", 1)["id"])
        # all codes up to the distance at which k + 1 ids are reached
        upto = Window.partitionBy("q").orderBy("distance").rangeBetween(Window.unboundedPreceding, -1)
        new = met.hint("merge").join(base, "code").select("q", "code", "distance", "ids")
        both = new if best is None else best.unionByName(new)
        top = save(both.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k + 1)
                   .withColumn("have", F.coalesce(F.sum(F.size("ids")).over(upto), F.lit(0)))
                   .where(F.col("have") < k + 1).select("q", "code", "distance", "ids"), "top")
        if best is not None:
            drop_saved(best)
        best = top
        sure = len(parts) * (r + 1) - 1
        kth = best.groupBy("q").agg(F.sum(F.size("ids")).alias("have"), F.max("distance").alias("kth"))
        full = F.col("have") >= k + 1
        still = save(open_q.select("q").hint("merge").join(kth, "q", "left")
                     .where(~F.coalesce(full & (F.col("kth") <= sure), F.lit(False)))
                     .select("q", F.when(full, F.col("kth")).otherwise(F.lit(WORD * n_words)).alias("bound")), "open")
        drop_saved(open_q)
        open_q = still
        if r == most or not open_q.limit(1).count():
            break
    rows = (best.select("q", "distance", F.explode("ids").alias("x"))
            .select("q", "distance", F.col("x.id").alias("neighbour_id"),
                    F.explode(F.sequence(F.lit(1).cast("long"), F.col("x.copies"))).alias("_copy")))
    # one list per code, then dealt to the queries with that code: every list is bounded by k + 1 codes' ids
    hits = (asked.select(F.col("id").alias("query_id"), F.col("code").alias("q")).distinct().hint("merge").join(rows, "q")
            .where("query_id <> neighbour_id"))
    order = Window.partitionBy("query_id").orderBy("distance", "neighbour_id", "_copy")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "neighbour_id", F.col("distance").cast("long").alias("distance")))
