"""Exact removal of repeated byte strings (suffix order by deep-shallow sorting).

Texts are UTF-8 bytes.  A byte goes if it is covered by a string of ``width`` (200)
bytes that also starts anywhere else in the corpus, the same text included; strings
are judged on the input, overlaps count, and no string crosses texts.

A suffix array over the whole corpus would move every suffix.  Instead:

1. anchors: of the 32-byte grams in every 200-byte string the one with the smallest
   hash is its anchor (about one position in 85 is one).  Equal strings have equal
   anchors at equal places, so strings can only repeat among suffixes that start at
   anchors with the same gram.  Only (gram, context fingerprint, text, position) is
   shuffled; grams that occur once go, and equal contexts are one record from here;
2. sorting: the distinct contexts of one gram (up to 168 bytes before, 200 after) are
   put into suffix order twice, forwards from the anchor and backwards before it:
   multikey quicksort on 8-byte characters to a shallow depth, then blind tries for
   the groups with longer common prefixes.  From common prefix lengths R and L of two
   contexts, the strings that start x bytes before the anchor agree for
   200 - R <= x <= L;
3. grams with more than ``group_rows`` distinct contexts are not gathered in one task:
   their strings are compared as (gram, x, fingerprint) rows by an aggregate;
4. spans: intervals come back to all texts with the context and are merged per text.

Texts are worked off as distinct contents (64-bit fingerprint): equal texts of at
least 200 bytes repeat each other and go whole.

Defined cases: null text is empty; repeated rows repeat each other; texts below 200
bytes lose nothing; rows with null or equal ids are separate documents; an empty
table gives an empty result; other columns are kept by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import PrefixHash, chunks, drop_saved, mix64, save, save_bucketed, signed
from ledgerlens.llm.ngram_join import runs

WIDTH = 200
GRAM = 32
BEFORE = WIDTH - GRAM        # bytes before an anchor that a string can hold
SHALLOW = 16


# --- deep-shallow sorting -------------------------------------------------------------------------------------------

def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class BlindTrie:
    """Patricia trie over strings with a known common prefix; inner nodes hold depths only.

    A string is led down by the characters at the nodes' depths alone, compared
    once with the leaf it ends at, and hung in at the depth where they part.
    Nodes: [depth, {character: child}]; leaves: lists of string numbers.
    """

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    def add(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [None, [i]]
            return
        node = self.root
        while node[0] is not None:
            kids = node[1]
            node = kids.get(s[node[0]] if node[0] < len(s) else -1) or next(iter(kids.values()))
        other = self.strings[node[1][0]]
        depth = common_prefix(s, other)
        if depth == len(s) == len(other):
            node[1].append(i)
            return
        at, up, came = self.root, None, None
        while at[0] is not None and at[0] < depth:
            came = s[at[0]] if at[0] < len(s) else -1
            up, at = at, at[1].get(came)
            if at is None:
                up[1][came] = [None, [i]]
                return
        mine = s[depth] if depth < len(s) else -1
        theirs = other[depth] if depth < len(other) else -1
        if at[0] == depth:
            at[1][mine] = [None, [i]]
            return
        new = [depth, {theirs: at, mine: [None, [i]]}]
        if up is None:
            self.root = new
        else:
            up[1][came] = new

    def order(self) -> list[int]:
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if node[0] is None:
                out += node[1]
            else:
                stack += [node[1][c] for c in sorted(node[1], reverse=True)]
        return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], np.ndarray]:
    """Sorted order of ``strings`` and the common prefix length of each with the one before (first: 0)."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        part, depth = stack.pop()
        if len(part) <= 1:
            out += part
            continue
        if depth >= shallow:
            trie = BlindTrie(strings)
            for i in part:
                trie.add(i)
            out += trie.order()
            continue
        word = {i: strings[i][depth:depth + 8] for i in part}
        pivot = word[part[len(part) // 2]]
        less = [i for i in part if word[i] < pivot]
        same = [i for i in part if word[i] == pivot]
        more = [i for i in part if word[i] > pivot]
        stack.append((more, depth))
        stack.append((same, depth + 8 if len(pivot) == 8 else shallow))
        stack.append((less, depth))
    lcp = np.zeros(len(out), dtype=np.int64)
    for k in range(1, len(out)):
        lcp[k] = common_prefix(strings[out[k - 1]], strings[out[k]])
    return out, lcp


class _Least:
    """Range minima of an array (sparse table)."""

    def __init__(self, a: np.ndarray):
        self.rows = [a]
        while (1 << len(self.rows)) <= len(a):
            p, half = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(p[:len(p) - half], p[half:]))

    def over(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum over lo..hi (both included, lo <= hi)."""
        k = np.frexp((hi - lo + 1).astype(float))[1] - 1
        out = np.empty(len(lo), dtype=np.int64)
        for level in np.unique(k):
            at = k == level
            row = self.rows[level]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << int(level)) + 1])
        return out


def repeated_offsets(before: list[bytes], after: list[bytes], width: int = WIDTH) -> list[list[tuple[int, int]]]:
    """Per context the ranges (lo, hi) of x such that its string from x bytes before the anchor is in another context.

    ``before`` holds the bytes before each anchor in reverse.
    """
    m = len(after)
    out: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    if m < 2:
        return out
    right, lcp_r = deep_shallow(after)
    left, lcp_l = deep_shallow(before)
    rank = np.empty(m, dtype=np.int64)
    rank[left] = np.arange(m)
    least = _Least(lcp_l)
    right = np.array(right)
    best = np.full(m, -1, dtype=np.int64)
    # contexts that share r bytes after the anchor, for every r that occurs, longest first
    for r in np.unique(lcp_r[1:])[::-1].tolist():
        group = np.cumsum(lcp_r < r)
        order = np.lexsort((rank[right], group))
        who, g = right[order], group[order]
        pair = np.flatnonzero(g[1:] == g[:-1])
        shared = least.over(rank[who[pair]] + 1, rank[who[pair + 1]])
        top = np.full(m, -1, dtype=np.int64)
        np.maximum.at(top, who[pair], shared)
        np.maximum.at(top, who[pair + 1], shared)
        lo = max(0, width - r)
        for i in np.flatnonzero((top > best) & (top >= lo)).tolist():
            hi = int(top[i])
            if out[i] and lo <= out[i][-1][1] + 1:             # ranges come with growing ends on both sides
                out[i][-1] = (out[i][-1][0], hi)
            else:
                out[i].append((lo, hi))
        best = np.maximum(best, top)
    return out


# --- anchors --------------------------------------------------------------------------------------------------------

def _slide(a: np.ndarray, width: int, of) -> np.ndarray:
    """of(a[i:i + width]) for every i, by doubling."""
    have = 1
    while have * 2 <= width:
        a = of(a[:-have], a[have:])
        have *= 2
    return of(a[:len(a) - (width - have)], a[width - have:]) if have < width else a


def text_prints(buf: np.ndarray, off: np.ndarray, ph: PrefixHash) -> np.ndarray:
    """64-bit fingerprint of every text."""
    return mix64(ph.ranges(off[:-1], off[1:]) + np.uint64(11))


def find_anchors(buf: np.ndarray, off: np.ndarray, ph: PrefixHash):
    """(text number, byte position in the chunk, gram hash) of all anchors of a chunk of texts."""
    n = len(buf)
    if n < WIDTH:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - GRAM + 1)
    gram = ph.ranges(at, at + GRAM)
    rank = (gram >> np.uint64(32)).astype(np.uint32)
    low = _slide(rank, BEFORE + 1, np.minimum)                    # per start of a 200-byte string
    size = np.diff(off)
    text_of = np.repeat(np.arange(len(size)), size)
    inside = at[:len(low)] + WIDTH <= off[1:][text_of[:len(low)]]
    low = np.where(inside, low, 0)
    pad = np.zeros(BEFORE, dtype=np.uint32)
    high = _slide(np.concatenate([pad, low, pad]), BEFORE + 1, np.maximum)
    seen = _slide(np.concatenate([pad.astype(bool), inside, pad.astype(bool)]), BEFORE + 1, np.logical_or)
    pos = np.flatnonzero((high[:len(rank)] == rank) & seen[:len(rank)])
    # a gram that reaches into the next text is no gram of a string
    pos = pos[pos + GRAM <= off[1:][text_of[pos]]]
    return text_of[pos], pos, gram[pos]


ANCHORS = "kind int, gram long, rec long, tid long, pos long, before int, after int"


def _anchor_rows(batches):
    """Anchors of every content (kind 0), one for each context in it, and its spans of contexts it holds twice (kind 1).

    In periodic text every period is an anchor; but there a context comes again in
    the same text, so its bytes are repeats already and one row stands for all.
    """
    done: set[int] = set()
    names = ["kind", "gram", "rec", "tid", "pos", "before", "after"]
    for b in batches:
        for _, _, buf, off in chunks(b.column(0)):
            if not len(buf):
                continue
            ph = PrefixHash(buf)
            tid = text_prints(buf, off, ph)
            t, pos, gram = find_anchors(buf, off, ph)
            if len(done) > 200_000:
                done.clear()
            fresh = np.zeros(len(tid), dtype=bool)               # each content once per task
            for i, x in enumerate(tid.tolist()):
                if x not in done:
                    fresh[i] = True
                    done.add(x)
            keep = fresh[t]
            t, pos, gram = t[keep], pos[keep], gram[keep]
            if not len(pos):
                continue
            a, z = off[t], off[t + 1]
            before = np.minimum(pos - a, BEFORE)
            after = np.minimum(z - pos, WIDTH)
            rec = mix64(ph.ranges(pos - before, pos + after) + before.astype(np.uint64))
            _, first, back, count = np.unique(mix64(mix64(gram ^ t.astype(np.uint64)) ^ rec), return_index=True,
                                              return_inverse=True, return_counts=True)
            twice = np.flatnonzero((count[back] > 1) & (before + after >= WIDTH))
            if len(twice):
                lo, hi, tt = pos[twice] - before[twice], pos[twice] + after[twice], t[twice]
                cut = np.flatnonzero((lo[1:] > hi[:-1]) | (tt[1:] != tt[:-1])) + 1
                at, end = np.concatenate([[0], cut]), np.concatenate([cut - 1, [len(lo) - 1]])
                own, k = signed(tid[tt[at]]), len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ones(k, np.int32)), pa.array(own), pa.array(np.zeros(k, np.int64)), pa.array(own),
                     pa.array(lo[at] - off[tt[at]]), pa.array(np.zeros(k, np.int32)),
                     pa.array((hi[end] - lo[at]).astype(np.int32))], names=names)
            t, pos, gram, rec, before, after, a = (x[first] for x in (t, pos, gram, rec, before, after, a))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(len(pos), np.int32)), pa.array(signed(gram)), pa.array(signed(rec)),
                 pa.array(signed(tid[t])), pa.array(pos - a), pa.array(before.astype(np.int32)),
                 pa.array(after.astype(np.int32))], names=names)


def _with_tid(batches):
    """(text, ...) -> (tid, n_bytes, ...)"""
    for b in batches:
        tid, size = [], []
        for _, _, buf, off in chunks(b.column(0)):
            tid.append(signed(text_prints(buf, off, PrefixHash(buf))))
            size.append(np.diff(off))
        if tid:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tid)), pa.array(np.concatenate(size)), *b.columns],
                                             names=["tid", "n_bytes", *b.schema.names])


def with_tid(df: DataFrame) -> DataFrame:
    """``df``, whose first column is the text, with the text's fingerprint and size in front."""
    from pyspark.sql.types import LongType, StructType
    schema = StructType().add("tid", LongType()).add("n_bytes", LongType())
    for f in df.schema.fields:
        schema = schema.add(f)
    return df.mapInArrow(_with_tid, schema)


def _contents(batches):
    """(text) -> (tid, text), each content once per task as far as 200,000 are remembered."""
    done: set[int] = set()
    for b in batches:
        keep, tids = [], []
        for i0, _, buf, off in chunks(b.column(0)):
            for i, x in enumerate(signed(text_prints(buf, off, PrefixHash(buf))).tolist()):
                if x not in done:
                    done.add(x)
                    keep.append(i0 + i)
                    tids.append(x)
            if len(done) > 200_000:
                done.clear()
        if keep:
            yield pa.RecordBatch.from_arrays([pa.array(tids, pa.int64()), b.column(0).take(pa.array(keep))],
                                             names=["tid", "text"])


def _contexts(batches):
    """(text, [(gram, rec, pos, wide)]) -> (gram, rec, before reversed, after, wide)"""
    for b in batches:
        rows = []
        for text, marks in zip(b.column(0), b.column(1).to_pylist()):
            data = text.as_buffer().to_pybytes()
            for m in marks:
                p = m["pos"]
                rows.append((m["gram"], m["rec"], data[max(0, p - BEFORE):p][::-1], data[p:p + WIDTH], m["wide"]))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["gram", "rec", "before", "after", "wide"])


def _sorted_groups(batches):
    """Contexts sorted by gram -> (gram, rec, ranges): strings that are in another context too."""
    ranges = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    for (gram,), (rec, before, after) in runs(batches, 1):
        found = repeated_offsets(before.tolist(), after.tolist())
        rows = [(int(rec[i]), [{"lo": lo, "hi": hi} for lo, hi in r]) for i, r in enumerate(found) if r]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(gram)] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int64()),
                 pa.array([r[1] for r in rows], ranges)], names=["gram", "rec", "ranges"])


def _strings(batches):
    """Contexts -> (gram, rec, x, fingerprint of the string from x bytes before the anchor)."""
    for b in batches:
        for gram, rec, before, after in zip(*(c.to_pylist() for c in b.columns)):
            data = np.frombuffer(before[::-1] + after, dtype=np.uint8)
            x = np.arange(WIDTH - len(after), len(before) + 1)
            x = x[x >= 0]
            if not len(x):
                continue
            start = len(before) - x
            h = PrefixHash(data).ranges(start, start + WIDTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), gram)), pa.array(np.full(len(x), rec)), pa.array(x), pa.array(signed(h))],
                names=["gram", "rec", "x", "h"])


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def _cut(batches):
    """(tid, text, [(a, z)]) -> (tid, n_removed, n_spans, kept_sha256, kept)"""
    for b in batches:
        rows = []
        for tid, text, marks in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
            data = text.as_buffer().to_pybytes()
            spans = merge_spans([(m["a"], m["z"]) for m in marks])
            kept, last = [], 0
            for a, z in spans:
                kept.append(data[last:a])
                last = z
            kept = b"".join([*kept, data[last:]])
            rows.append((tid, len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept))
        if rows:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                             names=["tid", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_spans(src: DataFrame, copies: DataFrame, group_rows: int = 100_000):
    """(spans per text content, the contents they are in, the saved tables behind the spans).

    src: one column ``text``; copies: the fingerprints (tid) of contents that occur more than once.
    """
    n = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gram, rec = Window.partitionBy("kind", "gram"), Window.partitionBy("kind", "gram", "rec")
    here = F.struct("tid", "pos")
    # one exchange by gram; a text has at most one row for each of its contexts
    known = save(
        src.mapInArrow(_anchor_rows, ANCHORS).repartition(n, "kind", "gram")
        .withColumns({"first": F.min(here).over(rec), "last": F.max(here).over(rec)})
        .withColumns({"r0": F.min("rec").over(gram), "r1": F.max("rec").over(gram)})
        .where("kind = 1 or r0 <> r1 or first <> last")
        .select("kind", "gram", "rec", "tid", "pos", "before", "after", (F.col("first") < F.col("last")).alias("same"),
                (F.col("r0") < F.col("r1")).alias("several"), (F.col("first") == here).alias("lead")), "anchors")
    lead = known.where("kind = 0 and several and lead").select("gram", "rec", "tid", "pos")
    # grams with more contexts than one task gathers: at most one in group_rows rows
    big = lead.groupBy("gram").agg(F.count("*").alias("c")).where(F.col("c") > group_rows).select("gram")
    some = big.limit(1).count() > 0
    lead = lead.join(big.withColumn("wide", F.lit(True)), "gram", "left") if some else lead.withColumn(
        "wide", F.lit(None).cast("boolean"))
    # as a set: a content that several tasks have met is in there several times
    marks = lead.groupBy("tid").agg(F.collect_set(F.struct("gram", "rec", "pos", "wide")).alias("marks"))
    # contents that keep a part, and with them those whose bytes are needed: contexts are read from the latter
    alone = known.join(copies, "tid", "left_anti")
    need = alone.select("tid").union(marks.select("tid")).distinct()
    # read by two joins on tid
    texts = save_bucketed(src.mapInArrow(_contents, "tid long, text string").join(need, "tid").dropDuplicates(["tid"])
                          .select("tid", F.col("text").cast("binary").alias("text")), "tid", "texts")
    contexts = (texts.join(marks, "tid").select("text", "marks")
                .mapInArrow(_contexts, "gram long, rec long, before binary, after binary, wide boolean"))
    contexts = save(contexts, "contexts") if some else contexts
    found = (contexts.where("wide is null").drop("wide").repartition(n, "gram").sortWithinPartitions("gram")
             .mapInArrow(_sorted_groups, "gram long, rec long, ranges array<struct<lo: long, hi: long>>"))
    if some:
        rows = save(contexts.where("wide").drop("wide")
                    .mapInArrow(_strings, "gram long, rec long, x long, h long"), "strings")
        twice = (rows.groupBy("gram", "x", "h").agg(F.min("rec").alias("a"), F.max("rec").alias("b"))
                 .where("a <> b").select("gram", "x", "h"))
        found = found.unionByName(rows.join(twice, ["gram", "x", "h"]).groupBy("gram", "rec").agg(
            F.collect_list(F.struct(F.col("x").alias("lo"), F.col("x").alias("hi"))).alias("ranges")))
    found = save(found, "offsets")
    mine = alone.where("kind = 0 and several").select("gram", "rec", "tid", "pos").join(found, ["gram", "rec"]).select(
        "tid", F.expr(f"transform(ranges, r -> struct(pos - r.hi as a, pos - r.lo + {WIDTH} as z))").alias("part"))
    whole = alone.where(f"kind = 1 or same and before + after >= {WIDTH}").select(
        "tid", F.expr("array(struct(pos - before as a, pos + after as z))").alias("part"))
    spans = mine.unionByName(whole).groupBy("tid").agg(F.flatten(F.collect_list("part")).alias("spans"))
    return spans, texts, (known, found)


def _judged(df: DataFrame, id_col: str, text_col: str, group_rows: int):
    src = df.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = save(with_tid(df.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).alias("id"),
                                   F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("sha")))
                .drop("text"), "rows")
    copies = rows.groupBy("tid").agg(F.count("*").alias("c")).where("c > 1").select("tid")
    spans, texts, behind = repeated_spans(src, copies, group_rows)
    part = (texts.join(spans, "tid").select("tid", "text", "spans")
            .mapInArrow(_cut, "tid long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
    return rows, copies, part, (texts, *behind)


def repeat_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  group_rows: int = 100_000) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``df``."""
    rows, copies, part, temp = _judged(df, id_col, text_col, group_rows)
    part = save(part.drop("kept"), "cut")
    drop_saved(*temp)
    gone = (F.col("copy").isNotNull()) & (F.col("n_bytes") >= WIDTH)
    return (rows.join(copies.withColumn("copy", F.lit(True)), "tid", "left").join(part, "tid", "left")
            .select(F.col("id").alias(id_col), "n_bytes",
                    F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
                    F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
                    F.when(gone, F.lit(hashlib.sha256(b"").hexdigest()))
                    .otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256")))


def remove_repeats(df: DataFrame, text_col: str = "text", group_rows: int = 100_000) -> DataFrame:
    """``df`` with its texts cut; a character of which only some bytes are left goes with them."""
    _, copies, part, temp = _judged(df.withColumn("_id", F.lit(None).cast("long")), "_id", text_col, group_rows)

    def decode(batches):
        for b in batches:
            text = [x.as_buffer().to_pybytes().decode("utf-8", "ignore") for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(text, pa.string())], names=["tid", "_kept"])

    kept = part.select("tid", "kept").mapInArrow(decode, "tid long, _kept string")
    verdict = save(kept.withColumn("_copy", F.lit(False)).unionByName(
        copies.select("tid", F.lit(None).cast("string").alias("_kept"), F.lit(True).alias("_copy"))), "verdict")
    drop_saved(*temp)
    # plain names, so that no column of df is in the way
    plain = {c: f"_c{i}" for i, c in enumerate(df.columns) if c != text_col}
    marked = with_tid(df.select(F.col(text_col).alias("_text"), *[F.col(c).alias(x) for c, x in plain.items()]))
    text = (F.when(F.col("_copy") & (F.col("n_bytes") >= WIDTH), F.lit(""))
            .otherwise(F.coalesce("_kept", "_text")))
    return marked.join(verdict, "tid", "left").select(
        *[(text if c == text_col else F.col(plain[c])).alias(c) for c in df.columns])
