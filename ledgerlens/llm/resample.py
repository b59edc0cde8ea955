"""Importance resampling towards a target distribution (hashed n-gram features).

Every text becomes a sparse count vector over ``buckets`` hash buckets of its word
runs.  A bucket's gain is the log ratio of its smoothed share in the target and in
the corpus; a text's weight is the floored mean gain of its features, looked up in
one array by bucket.  Gumbel noise from a hash of the id turns the highest scores
into a draw without replacement.

The cutoff of the draw is found on the written scores by bisection: each job counts
the rows at or above the 15 next midpoints (four bisection steps at once), then
the same over the ids of the rows tied at the cutoff.  Only counts reach the
driver.  The selected rows are range-partitioned by (score, id) and numbered by
prefix sums, so no task holds more than its range.

Words are runs of bytes 0-9, a-z (A-Z lower-cased) and all of non-ASCII; features
are the runs of 1 to ``max_n`` consecutive words joined by one blank, repeats counted.

Defined cases: null or empty text has no features and weight 0; null id hashes like
the empty string and loses ties; rows equal in score and id are drawn by a row
number fixed when the scores are written, so the draw has exactly its size; an
empty target or corpus still gives smoothed gains; an empty table gives an empty
result; columns other than id and text are not read, so their names cannot clash.
Texts are worked on in pieces of some 512 KB, at most 65,536 words at a time; what
is kept of one text is one number pair per bucket it hits.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from ledgerlens.llm.common import LOWER, drop_saved, pieces, save, word_bounds
from ledgerlens.llm.mixing import prefix_sums

BUCKETS = 10_000
BLOCK = 1 << 16           # words hashed at a time
_VECTOR = 48              # longer words are hashed one by one

IS_GAP = np.ones(256, dtype=bool)
IS_GAP[0x30:0x3A] = IS_GAP[0x41:0x5B] = IS_GAP[0x61:0x7B] = IS_GAP[0x80:] = False


def _crc_table() -> np.ndarray:
    """The byte table of CRC-32 from its (reflected) polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


_CRC = _crc_table()


def extend_crc(crc: np.ndarray, buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """CRC-32 values (as zlib gives them) carried on over the byte ranges ``s..e`` of ``buf``."""
    out = ~crc
    size = e - s
    order = np.argsort(-size, kind="stable")
    n_long = int(np.count_nonzero(size > _VECTOR))
    for i in order[:n_long]:
        out[i] = ~np.uint32(zlib.crc32(buf[s[i]:e[i]].tobytes(), int(~out[i])))
    order = order[n_long:]
    live, start, left = out[order], s[order], size[order]
    for k in range(int(left[0]) if len(left) else 0):
        m = int(np.searchsorted(-left, -k, side="left"))       # ranges longer than k come first
        live[:m] = _CRC[(live[:m] ^ buf[start[:m] + k]) & 0xFF] ^ (live[:m] >> 8)
    out[order] = live
    return ~out


def _count(col: pa.Array, buckets: int, max_n: int):
    """Per text: words, features, and its (bucket, count) pairs in order of bucket."""
    n_rows = len(col)
    n_words, n_features = np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    blank = np.array([32], dtype=np.uint8)
    carried = np.zeros(0, np.uint8)                            # the last max_n - 1 words of a text that goes on
    n_carried = 0
    for row, buf, off, goes_on in pieces(col, IS_GAP):
        if len(carried):
            buf = np.concatenate([carried, blank, buf])
            off = np.array([0, len(buf)])
        low = LOWER[buf]
        s, e, first = word_bounds(low, off, IS_GAP)
        n_words[row:row + len(off) - 1] += np.diff(first) - n_carried
        text = np.repeat(np.arange(row, row + len(off) - 1), np.diff(first))
        last = np.repeat(first[1:], np.diff(first))            # one past the text's last word
        low = np.concatenate([low, blank])
        for at in range(0, len(s), BLOCK):
            here = np.arange(at, min(at + BLOCK, len(s)))
            crc = np.zeros(len(here), np.uint32)
            for n in range(1, max_n + 1):
                keep = here + n <= last[here]
                here, crc = here[keep], crc[keep]
                if n > 1:
                    end = np.full(len(here), len(low))
                    crc = extend_crc(crc, low, end - 1, end)
                crc = extend_crc(crc, low, s[here + n - 1], e[here + n - 1])
                new = here + n > n_carried                     # runs inside the carried words are counted already
                k, c = np.unique(text[here[new]] * buckets + crc[new] % np.uint32(buckets), return_counts=True)
                keys.append(k)
                counts.append(c)
        if goes_on and len(s) and max_n > 1:
            n_carried = min(max_n - 1, len(s))
            carried = buf[s[-n_carried]:e[-1]].copy()
        elif not goes_on:
            carried, n_carried = carried[:0], 0
        if sum(map(len, keys)) > 4 * BLOCK:
            keys, counts = ([x] for x in _merge(keys, counts))
    keys, counts = _merge(keys, counts)
    at = np.searchsorted(keys, np.arange(n_rows + 1) * buckets)
    np.add.at(n_features, keys // buckets, counts)
    return n_words, n_features, at, keys % buckets, counts


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, where = np.unique(np.concatenate(keys), return_inverse=True)
    c = np.zeros(len(k), np.int64)
    np.add.at(c, where, np.concatenate(counts))
    return k, c


def hashed_features(df: DataFrame, id_col: str | None = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
                    max_n: int = 1) -> DataFrame:
    """(id, n_words, n_features, buckets, counts): each text's sparse feature counts."""
    src = df.select(F.col(id_col).cast("long").alias("id") if id_col else F.lit(None).cast("long").alias("id"),
                    F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            words, features, at, key, count = _count(b.column(1), buckets, max_n)
            at = pa.array(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words), pa.array(features),
                 pa.ListArray.from_arrays(at, pa.array(key.astype(np.int32))),
                 pa.ListArray.from_arrays(at, pa.array(count))],
                names=["id", "n_words", "n_features", "buckets", "counts"])

    schema = StructType([StructField("id", LongType()), StructField("n_words", LongType()),
                         StructField("n_features", LongType()), StructField("buckets", ArrayType(IntegerType())),
                         StructField("counts", ArrayType(LongType()))])
    return src.mapInArrow(run, schema)


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 ln) of the smoothed share in the target over that in the corpus, for every bucket."""
    def totals(feats: DataFrame, name: str) -> DataFrame:
        pairs = feats.selectExpr("inline(arrays_zip(buckets, counts))")
        return pairs.groupBy(F.col("buckets").cast("long").alias("id")).agg(F.sum("counts").alias(name))
    every = (corpus.sparkSession.range(buckets).join(totals(corpus, "s"), "id", "left")
             .join(totals(target, "t"), "id", "left").select("id", *[F.coalesce(c, F.lit(0)).alias(c) for c in "st"]))
    every = save(every, "gains")                               # one row per bucket
    total = every.agg(F.sum("s").alias("s"), F.sum("t").alias("t")).first()
    num = (F.col("t") + 1).cast("double") * F.lit(float(total.s + buckets))
    den = (F.col("s") + 1).cast("double") * F.lit(float(total.t + buckets))
    gains = every.select("id", F.floor(1000 * F.log(num / den)).cast("long").alias("g")).orderBy("id").collect()
    drop_saved(every)
    return [r.g for r in gains]


def first_covering(df: DataFrame, col: str, need: int) -> tuple[int, int] | None:
    """(d, rows below d) for the smallest integer d with at least ``need`` rows at or below it.

    Bisection over the values' range: each job counts the rows at or below 15
    points, the midpoints that four steps could ask for.  None if fewer rows have a value.
    """
    ends = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"), F.count(col).alias("n")).first()
    if need < 1 or ends.n < need:
        return None
    lo, hi, below = ends.lo, ends.hi, 0
    while lo < hi:                                             # invariant: lo <= d <= hi, ``below`` rows lie below lo
        points = sorted({lo + (hi - lo) * i // 16 for i in range(1, 16)} - {hi})
        got = df.agg(*[F.count(F.when(F.col(col) <= F.lit(p), 1)) for p in points]).first()
        for p, n in zip(points, got):
            if n >= need:
                hi = p
                break
            lo, below = p + 1, n
    return lo, below


def score_documents(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    target_text_col: str = "text", buckets: int = BUCKETS, max_n: int = 1,
                    seed: str = "2024") -> DataFrame:
    """Written table (id, n_words, n_features, weight, score, row) of all rows of ``df``."""
    feats = save(hashed_features(df, id_col, text_col, buckets, max_n), "features")
    gains = bucket_gains(feats, hashed_features(target, None, target_text_col, buckets, max_n), buckets)
    table = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<bigint>")       # one folded literal
    total = F.aggregate(F.zip_with("buckets", "counts", lambda b, c: F.element_at(table, b + 1) * c),
                        F.lit(0).cast("long"), lambda a, x: a + x)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
                                  .cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = (feats.withColumn("total", total)
              .withColumn("weight", F.when(F.col("n_features") > 0,
                                           F.expr("(total - pmod(total, n_features)) div n_features"))
                          .otherwise(F.lit(0)).cast("long"))
              .select("id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"),
                      F.monotonically_increasing_id().alias("row")))
    out = save(scored, "scores")
    drop_saved(feats)
    return out


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", percent: int = 10, min_words: int = 20, **how) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; rank 1, 2, ... in the draw, null outside.

    Drawn are floor(percent * N / 100) of the N rows with at least ``min_words`` words:
    highest score first, ties to the smaller id.
    """
    scored = score_documents(df, target, id_col, text_col, target_text_col, **how).withColumn("neg", -F.col("score"))
    able = scored.where(F.col("n_words") >= min_words)
    size = able.count() * percent // 100
    cut = first_covering(able.select("neg"), "neg", size)
    out = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    nobody = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*out, nobody)
    neg, above = cut
    tied = able.where(F.col("neg") == neg)
    last = first_covering(tied.select("id"), "id", size - above)
    # ids up to the last one needed; without enough ids all of them, and rows without id
    in_tie = F.col("id") <= last[0] if last else F.lit(True)
    chosen = F.coalesce((F.col("n_words") >= min_words)
                        & ((F.col("neg") < neg) | ((F.col("neg") == neg) & in_tie)), F.lit(False))
    picked = (scored.where(chosen).withColumn("no_id", F.col("id").isNull()).withColumn("one", F.lit(1).cast("long")))
    ranked = prefix_sums(picked, [], ["neg", "no_id", "id", "row"], {"before": "one"})
    rank = F.when(F.col("before") < size, F.col("before") + 1).alias("rank")      # rows equal to the last one stay out
    return scored.where(~chosen).select(*out, nobody).unionByName(ranked.select(*out, rank))


def drawn(df: DataFrame, result: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` whose id the draw holds, all columns."""
    ids = result.where(F.col("rank").isNotNull() & F.col(id_col).isNotNull()).select(id_col).distinct()
    return df.join(ids, id_col, "left_semi")
