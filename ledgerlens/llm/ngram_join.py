"""Jaccard self-join on word 5-grams as T-occurrence search (DivideSkip).

A document's set holds its distinct 5-word shingles (A-Z lower-cased; a shorter
text is one shingle; without words the set is empty and links with nothing).  Two
documents link when 100 * |A and B| >= 80 * |A or B|.  Sets are 64-bit shingle
fingerprints; documents with equal sets (64-bit set fingerprint) form one class,
which is compared once however many copies it has.

T-occurrence.  A partner of a set of n shares at least T = ceil(0.8 n) of its
inverted lists.  DivideSkip sets the T - h longest lists aside: a partner must then
occur on at least h of the n - T + h short ones (h grows with T, so that a passage in
common does not make long texts candidates).  Lists are ranked by one order for
all documents: the most frequent shingles of the corpus (a bounded table gathered
from all rows) come last by their count, the others first by fingerprint.  The
order decides the cost, never a result.

1. short lists: postings of the n - T + h first shingles; those of shingles with one
   class only go, then classes with fewer than h postings left;
2. seed: every class is tried against the most central class it meets on its lists,
   and the verified links are contracted to components, so a large group of near
   copies hangs together without listing its pairs;
3. merge: on short lists that still hold several components a class first meets
   the other components, then, where the first shared shingle of a link can lie at
   their places, the members of the smaller one; the lists of such pairs are merged with a
   heap for partners that occur often enough.  One class per two components asks
   first, and what links is contracted before all others ask;
4. probe: candidates are verified by binary probing of the sorted set, long lists
   included; what reaches the overlap links.

No partner or candidate is capped.  Links inside a component found by the seed step
are not listed one by one; every component is whole.

Defined cases: null text is an empty set; documents with null id get their number of
shingles, a null component and link with nothing; repeated rows give repeated rows;
rows that share an id but not a text count as one document with either text; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import chunks, components, drop_saved, mix64, save, shingles, signed

LEAST_HITS, HIT_SHARE = 3, 12     # h = LEAST_HITS + T // HIT_SHARE occurrences are asked for on the short lists
ORDER_ROWS = 1 << 17     # entries of the broadcast order table, 12 bytes each
BLOCK_SHINGLES = 1 << 18  # shingles of one class's partners merged and probed at a time
PARTNERS = 64            # partners of one class verified by one task
LARGE = 4                # classes of components that are tried by one member first


def doc_sets(col: pa.Array):
    """(row, sorted distinct shingle fingerprints) of every text in an Arrow column."""
    for i0, _, buf, off in chunks(col):
        h, o, _ = shingles(buf, off)
        for r in range(len(off) - 1):
            yield i0 + r, np.unique(h[o[r]:o[r + 1]])


def set_print(s: np.ndarray) -> int:
    return int(signed(mix64(np.array([mix64(s + np.uint64(7)).sum(dtype=np.uint64) + np.uint64(len(s))]))
                      .astype(np.uint64))[0])


def needed(n: np.ndarray | int):
    """T: lists that a partner of a set of n shares at least."""
    return (4 * n + 4) // 5


def hits(n: int) -> int:
    """h: occurrences on its short lists that a set of n asks of a partner (as many as there are, if fewer)."""
    t = needed(n)
    return min(t, LEAST_HITS + t // HIT_SHARE)


def list_order(src: DataFrame, per_task: int = 4096, rows: int = ORDER_ROWS) -> np.ndarray:
    """The corpus's most frequent shingles, sorted by fingerprint, with their rank by count.

    Every task counts the shingles of all its documents and hands out its most
    frequent ones; at most ``rows`` of the sums reach the driver.
    """

    def tally(batches):
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            for _, _, buf, off in chunks(b.column(1)):
                h, _, _ = shingles(buf, off)
                u, c = np.unique(h, return_counts=True)
                more = c > 2
                k, back = np.unique(np.concatenate([keys, u[more]]), return_inverse=True)
                c = np.bincount(back, weights=np.concatenate([counts, c[more]])).astype(np.int64)
                if len(k) > 64 * per_task:
                    top = np.sort(np.argsort(-c, kind="stable")[:32 * per_task])
                    k, c = k[top], c[top]
                keys, counts = k, c
        top = np.argsort(-counts, kind="stable")[:per_task]
        if len(top):
            yield pa.RecordBatch.from_arrays([pa.array(signed(keys[top])), pa.array(counts[top])], names=["token", "c"])

    top = (src.mapInArrow(tally, "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))
           .orderBy(F.desc("c"), "token").limit(rows).select("token").toPandas().token.to_numpy(dtype=np.int64))
    out = np.zeros(len(top), dtype=[("token", np.uint64), ("rank", np.uint32)])
    out["token"], out["rank"] = top.view(np.uint64), np.arange(len(top), 0, -1)
    return np.sort(out, order="token")


def short_list(s: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The n - T + h first shingles of a set in the order of lists."""
    n = len(s)
    size = n - needed(n) + hits(n)
    if len(order):
        i = np.minimum(np.searchsorted(order["token"], s), len(order) - 1)
        rank = np.where(order["token"][i] == s, order["rank"][i], 0)
        rare = s[rank == 0]
        if len(rare) >= size:
            return rare[:size]
        often = np.flatnonzero(rank)
        return np.concatenate([rare, s[often[np.argsort(rank[often], kind="stable")]]])[:size]
    return s[:size]


def runs(batches, keys: int):
    """(key, columns) of consecutive rows with equal first ``keys`` columns, across batches; numpy columns."""
    held = None
    for b in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if not len(cols[0]):
            continue
        if held is not None:
            cols = [np.concatenate([x, y]) for x, y in zip(held, cols)]
        change = np.zeros(len(cols[0]), dtype=bool)
        for c in cols[:keys]:
            change[1:] |= c[1:] != c[:-1]
        at = [0, *np.flatnonzero(change).tolist()]
        for a, z in zip(at, at[1:]):
            yield tuple(c[a] for c in cols[:keys]), [c[a:z] for c in cols[keys:]]
        held = [c[at[-1]:] for c in cols]
    if held is not None:
        yield tuple(c[0] for c in held[:keys]), [c for c in held[keys:]]


def merge_skip(lists: list[np.ndarray], least: int):
    """Members that occur on at least ``least`` of the sorted lists, with their occurrences (heap merge)."""
    for member, same in groupby(heapq.merge(*[x.tolist() for x in lists])):
        n = sum(1 for _ in same)
        if n >= least:
            yield member, n


def pair_hits(n: int, m: int) -> int:
    """Occurrences on both short lists that sets of n and m have if they link.

    They share O >= 4 (n + m) / 9 shingles.  In the order of lists the j-th of these lies at most
    at place j + n - O of the one set, which is on its n - T + h short lists for j <= O - T + h.
    """
    shared = -(-4 * (n + m) // 9)
    return min(shared - needed(n) + hits(n), shared - needed(m) + hits(m))


def first_cap(n: int, place: np.ndarray) -> np.ndarray:
    """Largest size of a partner whose first shared shingle is the one at ``place`` of a set of n.

    Sets of n and m share at least O = 4 (n + m) / 9 shingles if they link, so the first
    of them in the order of lists has at most n - O before it: 4 m <= 5 n - 9 place.
    """
    return ((5 * n - 9 * place) // 4).astype(np.int32)


def _hits_reached(base: np.ndarray, partners: list[np.ndarray], order: np.ndarray) -> list[int]:
    """Places of the partners that meet ``base`` often enough on the short lists (heap merge of its lists)."""
    short = np.sort(short_list(base, order))
    members, tokens = [], []
    for k, s in enumerate(partners):
        mine = short_list(s, order)
        at = np.minimum(np.searchsorted(short, mine), len(short) - 1)
        hit = mine[short[at] == mine]
        tokens.append(hit)
        members.append(np.full(len(hit), k))
    token, member = np.concatenate(tokens), np.concatenate(members)
    by = np.lexsort((member, token))
    token, member = token[by], member[by]
    lists = np.split(member, np.flatnonzero(token[1:] != token[:-1]) + 1)
    least = [pair_hits(len(base), len(s)) for s in partners]
    return [k for k, n in merge_skip(lists, min(least)) if n >= least[k]]


def _probe(order):
    """Rows (b, salt, a, set) sorted with b's own set (a null) first -> pairs that link.

    Partners are taken in blocks: the short lists are merged, and those that occur often
    enough are probed in the whole sorted set, long lists included.
    """
    def links_of(b: int, base: np.ndarray, held: list) -> list[tuple[int, int]]:
        found = []
        for k in _hits_reached(base, [s for _, s in held], order.value) if held else []:
            a, s = held[k]
            small, large = (s, base) if len(s) <= len(base) else (base, s)
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            both = int((large[at] == small).sum())
            if 100 * both >= 80 * (len(s) + len(base) - both):
                found.append((a, b))
        return found

    def run(batches):
        now, base, held, size = None, None, [], 0
        for batch in batches:
            found = []
            bs, salts, members, sets = (batch.column(k) for k in range(4))
            for k in range(batch.num_rows):
                key, a = (bs[k].as_py(), salts[k].as_py()), members[k].as_py()
                s = np.frombuffer(sets[k].as_buffer(), dtype=np.uint64).copy()
                if a is None:
                    found += links_of(now[0], base, held) if held else []
                    now, base, held, size = key, s, [], 0
                    continue
                if key != now:
                    raise ValueError("a set is missing")
                held.append((a, s))
                size += len(s)
                if size > BLOCK_SHINGLES:
                    found += links_of(now[0], base, held)
                    held, size = [], 0
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])
        found = links_of(now[0], base, held) if held else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found)], names=["a", "b"])
    return run


def parity(s: np.ndarray) -> bytes:
    """Parity bits of a set: bit h(x) is flipped by every member x; 2 to 4 bits a member, a power of two."""
    n = max(512, 1 << (2 * len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _close(batches):
    """Rows (a, b, na, nb, bitsa, bitsb) -> pairs whose bits differ in no more places than sets that link in members.

    Equal members cancel out, so sets differ in at least as many members as their
    parity bits in places; folding the longer bits in half keeps this true.
    """
    for batch in batches:
        keep = []
        na, nb = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3))
        most = na + nb - 2 * needed_of_both(na, nb)
        for k in range(batch.num_rows):
            x, y = (np.frombuffer(batch.column(i)[k].as_buffer(), dtype=np.uint8) for i in (4, 5))
            while len(x) != len(y):
                if len(x) < len(y):
                    x, y = y, x
                x = x[:len(x) // 2] ^ x[len(x) // 2:]
            keep.append(int(np.unpackbits(x ^ y).sum()) <= most[k])
        if any(keep):
            at = pa.array(np.flatnonzero(keep))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at)], names=["a", "b"])


def needed_of_both(n, m):
    """Members that sets of n and m share at least if they link."""
    return (4 * (n + m) + 8) // 9


def _near_enough(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    bits = lambda k: sets.select(F.col("cls").alias(k), F.col("n").alias(f"n{k}"), F.col("bits").alias(f"bits{k}"))
    return (pairs.join(bits("a"), "a").join(bits("b"), "b").select("a", "b", "na", "nb", "bitsa", "bitsb")
            .mapInArrow(_close, "a long, b long"))


def verify(pairs: DataFrame, sets: DataFrame, order) -> DataFrame:
    """Pairs (a, b) of classes that reach the overlap; a class's pairs are dealt to tasks of ``PARTNERS`` at most about."""
    near = save(_near_enough(pairs, sets), "near")
    load = near.groupBy("b").agg((F.floor(F.count("*") / PARTNERS) + 1).cast("int").alias("salts"))
    p = near.join(load, "b").withColumn("salt", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int"))
    whole = sets.select("cls", "set")
    member = p.join(whole.withColumnRenamed("cls", "a"), "a").select("b", "salt", "a", "set")
    own = (p.select("b", "salt").distinct().join(whole.withColumnRenamed("cls", "b"), "b")
           .select("b", "salt", F.lit(None).cast("long").alias("a"), "set"))
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (member.unionByName(own).repartition(n, "b", "salt")
            .sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first()).mapInArrow(_probe(order), "a long, b long"))


def _fits(a: str, b: str):
    return F.least(a, b) * 5 >= F.greatest(a, b) * 4


def links(src: DataFrame, sig: DataFrame) -> DataFrame:
    """Verified links (a, b) between classes; every pair that reaches the overlap is joined by a chain of them."""
    spark = src.sparkSession
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = spark.sparkContext.broadcast(list_order(src))

    def postings(batches):
        seen: set[int] = set()                   # classes this task has handed out (copies mostly lie together)
        for b in batches:
            tokens, cls, size, cap = [], [], [], []
            for _, s in doc_sets(b.column(1)):
                if not len(s):
                    continue
                c = set_print(s)
                if c in seen:
                    continue
                if len(seen) > 50_000:
                    seen.clear()
                seen.add(c)
                short = short_list(s, order.value)
                tokens.append(signed(short))
                cls.append(np.full(len(short), c, dtype=np.int64))
                size.append(np.full(len(short), len(s), dtype=np.int32))
                cap.append(first_cap(len(s), np.arange(len(short))))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, cls, size, cap)],
                                                 names=["token", "cls", "n", "cap"])

    t = F.floor((F.col("n") * 4 + 4) / 5)
    asked = F.least(t, F.lit(LEAST_HITS) + F.floor(t / HIT_SHARE))
    # a token's list ends where another begins, so one exchange serves both steps; only counts are kept per token
    once = (src.mapInArrow(postings, "token long, cls long, n int, cap int").repartition(n_tasks, "token")
            .groupBy("token", "cls").agg(F.first("n").alias("n"), F.first("cap").alias("cap")))
    several = save(once.withColumn("df", F.count("*").over(Window.partitionBy("token")))
                   .where("df > 1").select("token", "cls", "n", "cap"), "postings")
    met = (several.groupBy("cls", "n").agg(F.count("*").alias("met")).where(F.col("met") >= asked)
           .withColumn("central", F.col("met") / F.col("n")))
    met = save(met, "met")
    post = save(several.join(met.select("cls", "met", "central"), "cls"), "postings")
    drop_saved(several)

    # sets of the classes that have postings left, from one document each
    reps = sig.join(met.select("cls"), "cls", "left_semi").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))

    def make_sets(batches):
        for b in batches:
            want = b.column(2).to_pylist()
            rows = [(want[i], len(s), parity(s), s.tobytes()) for i, s in doc_sets(b.column(1)) if len(s) and set_print(s) == want[i]]
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["cls", "n", "bits", "set"])

    sets = save(src.join(reps, "doc_id").select("doc_id", "text", "cls")
                .mapInArrow(make_sets, "cls long, n int, bits binary, set binary").dropDuplicates(["cls"]), "sets")

    # seed: the most central class on each list, the one met on most lists
    hubs = post.groupBy("token").agg(F.max(F.struct("central", "n", "cls")).alias("hub"))
    tried = (post.join(hubs, "token").select("cls", "n", F.col("hub.cls").alias("b"), F.col("hub.n").alias("nb"))
             .where((F.col("cls") != F.col("b")) & _fits("n", "nb"))
             .groupBy("cls", "b").agg(F.count("*").alias("c")))
    first = (tried.groupBy("cls").agg(F.max(F.struct("c", "b")).alias("x"))
             .select(F.col("cls").alias("a"), F.col("x.b").alias("b")))
    seed = save(verify(first, sets, order), "seed")
    comp = components(seed)

    # merge: what other components occur on the short lists
    placed = save(post.join(comp.withColumnRenamed("node", "cls"), "cls", "left")
                  .select("token", "cls", "n", "cap", F.coalesce("component", "cls").alias("comp")), "placed")
    drop_saved(post, comp)
    found = [seed]
    for large_only in (True, False):
        lists = save(_open_lists(placed), "open")
        drop_saved(placed)
        pairs = save(_partners(lists, large_only).select(F.col("q").alias("a"), F.col("c").alias("b")), "pairs")
        cross = save(verify(pairs, sets, order), "cross")
        found.append(cross)
        if large_only:                      # contract what linked; the rest is tried member by member
            at = lists.select("cls", "comp").distinct()
            joined = (cross.join(at.select(F.col("cls").alias("a"), F.col("comp").alias("u")), "a")
                      .join(at.select(F.col("cls").alias("b"), F.col("comp").alias("v")), "b").select("u", "v").distinct())
            again = components(joined, "u", "v").select(F.col("node").alias("comp"), "component")
            placed = save(lists.join(again, "comp", "left").select(
                "token", "cls", "n", "cap", F.coalesce("component", "comp").alias("comp")), "placed")
            drop_saved(lists)
    drop_saved(lists, sets)
    return reduce(DataFrame.unionByName, found)


def _open_lists(placed: DataFrame) -> DataFrame:
    """Lists that hold several components, with ``w``, the number of classes of a posting's component on them."""
    several = (placed.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
               .select("token"))
    lists = placed.join(several, "token", "left_semi")
    return lists.join(lists.select("comp", "cls").distinct().groupBy("comp").agg(F.count("*").alias("w")), "comp")


def _partners(lists: DataFrame, large_only: bool) -> DataFrame:
    """Distinct pairs (q, c) of classes of different components that can link.

    Every list is first joined with the components on it, not with their classes,
    and the first shared shingle of a link must lie there (``first_cap``).  A class is
    asked about components of at most its own component's size, so the components
    that are then joined member by member are the smaller ones.  ``large_only``: of every two
    components of ``LARGE`` or more classes, the class that meets the other one most often.
    """
    comps = lists.groupBy("token", F.col("comp").alias("cc"), F.col("w").alias("wc")).agg(
        F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("cap").alias("kc"), F.first("cls").alias("c"))
    asks = lists.select("token", F.col("cls").alias("q"), F.col("n").alias("nq"), F.col("cap").alias("kq"),
                        F.col("comp").alias("cq"), F.col("w").alias("wq"))
    if large_only:
        comps, asks = comps.where(F.col("wc") >= LARGE), asks.where(F.col("wq") >= LARGE)
    met = asks.join(comps, "token").where(
        ((F.col("wc") < F.col("wq")) | ((F.col("wc") == F.col("wq")) & (F.col("cc") < F.col("cq"))))
        & (F.col("nq") <= F.col("kc")) & (F.col("n0") <= F.col("kq"))
        & (F.col("n0") * 4 <= F.col("nq") * 5) & (F.col("nq") * 4 <= F.col("n1") * 5)).drop("wq", "kc", "n0", "n1")
    if large_only:
        met = save(met, "met")
        one = (met.groupBy("cq", "cc", "q").agg(F.count("*").alias("k"))
               .groupBy("cq", "cc").agg(F.max_by("q", F.struct("k", "q")).alias("q")))
        met = met.join(one, ["cq", "cc", "q"], "left_semi")
    # a component of one class is its class; others are joined member by member
    members = lists.where("w > 1").select("token", F.col("comp").alias("cc"), F.col("cls").alias("c"), F.col("n").alias("nc"),
                                          F.col("cap").alias("kc"))
    alone = met.where("wc = 1").select("q", "c")
    return (met.where("wc > 1").drop("c").join(members, ["token", "cc"])
            .where((F.col("nq") <= F.col("kc")) & (F.col("nc") <= F.col("kq")) & _fits("nq", "nc"))
            .select("q", "c").unionByName(alone).distinct())


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) per row of ``df``."""
    src = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def sign(batches):
        for b in batches:
            n, cls = [], []
            for _, s in doc_sets(b.column(1)):
                n.append(len(s))
                cls.append(set_print(s) if len(s) else None)
            if n:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(cls, pa.int64())],
                                                 names=["doc_id", "n", "cls"])

    sig = save(src.mapInArrow(sign, "doc_id long, n long, cls long"), "sets-of")
    linked = sig.where("doc_id is not null and cls is not null")
    found = links(src.where("doc_id is not null"), linked.select("doc_id", "cls"))
    # rows that share an id are one document: their classes hang together
    first = linked.groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a <> b")
    same = linked.join(first.select("doc_id", "a"), "doc_id").where("cls <> a").select("a", F.col("cls").alias("b"))
    comp = components(found.unionByName(same.distinct()))
    ids = linked.groupBy("cls").agg(F.min("doc_id").alias("low"))
    ids = ids.join(comp.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "low", F.coalesce("component", "cls").alias("component"))
    low = save(ids.join(ids.groupBy("component").agg(F.min("low").alias("component_id")), "component")
               .select("cls", "component_id"), "classes")
    out = sig.join(low, "cls", "left")
    return out.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one document of every group: the one with the group's smallest id.

    Of rows that share that id one stays (by a hash of the text); rows without id stay.
    """
    keep = (jaccard_components(df, id_col, text_col).where(F.col("component_id") == F.col(id_col))
            .select(F.col(id_col).alias("_keep")).distinct())
    first = Window.partitionBy(id_col).orderBy(F.xxhash64(text_col))
    named = df.where(F.col(id_col).isNotNull()).join(keep, F.col(id_col) == F.col("_keep"), "left_semi")
    one = named.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")
    return one.select(*df.columns).unionByName(df.where(F.col(id_col).isNull()))
