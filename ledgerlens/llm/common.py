"""Helpers shared by the training-data operators.

Text helpers work on Arrow batches inside Spark tasks: a batch is cut into
chunks of whole texts (at most ``CHUNK_BYTES`` unless one text is longer), and
each chunk is tokenised and hashed with a handful of vectorised numpy passes.
Nothing here depends on the number of rows a task reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_dir

SHINGLE = 5              # words per shingle
CHUNK_BYTES = 1 << 19    # text bytes handled by one vectorised pass (some 40 bytes of arrays for each)
_U = np.uint64
_P = 0x9E3779B97F4A7C15 | 1                  # odd, so it has an inverse mod 2^64
_P_INV = pow(_P, -1, 1 << 64)
_WORD_MULT = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                       0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=_U)

IS_SPACE = np.zeros(256, dtype=bool)         # \x20 and \x09-\x0D
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)       # A-Z only
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE = mix64(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
_BYTE_LOWER = _BYTE[LOWER]
_POWERS: list[np.ndarray] = [np.ones(1, dtype=_U), np.ones(1, dtype=_U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^i and P^-i (mod 2^64) for i < n; kept up to the chunk size, made anew for longer texts."""
    if len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    size = max(n, CHUNK_BYTES + 1)
    out = []
    for base in (_P, _P_INV):
        a = np.full(size, base, dtype=_U)
        a[0] = 1
        out.append(np.multiply.accumulate(a))
    if size <= 4 * CHUNK_BYTES:
        _POWERS[:] = out
    return out[0][:n], out[1][:n]


class PrefixHash:
    """Hashes of any byte range of ``buf`` from one prefix sum (polynomial mod 2^64, then mixed)."""

    def __init__(self, buf: np.ndarray, lower: bool = False):
        pw, self._inv = _powers(len(buf) + 1)
        self._sum = np.zeros(len(buf) + 1, dtype=_U)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[buf] * pw[:-1], out=self._sum[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Before mixing: raw(xy) = raw(x) + P^len(x) raw(y)."""
        return (self._sum[end] - self._sum[start]) * self._inv[start]

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64(self.raw(start, end) + (end - start).astype(_U))


def joined_raw(raw_x: int, len_x: int, raw_y: int) -> int:
    """``PrefixHash.raw`` of x followed by y."""
    return (raw_x + pow(_P, len_x, 1 << 64) * raw_y) % (1 << 64)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string/binary Arrow column and its offsets (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    big = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off_buf, data = col.buffers()
    off = np.frombuffer(off_buf, dtype=np.int64 if big else np.int32)[col.offset:col.offset + len(col) + 1]
    off = off.astype(np.int64)
    if data is None or len(off) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]]
    return buf, off - off[0]


def chunks(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for consecutive runs of whole texts."""
    buf, off = text_buffer(col)
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + CHUNK_BYTES, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j, buf[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def pieces(col: pa.Array, gap: np.ndarray = IS_SPACE) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """Like ``chunks`` with texts beyond ``CHUNK_BYTES`` cut at gap bytes: (first row, bytes, offsets, goes on).

    A cut is made at the first gap byte after ``CHUNK_BYTES``, so words stay whole;
    "goes on" says that the next piece continues this one's only text.
    """
    for i, j, buf, off in chunks(col):
        at = 0
        while j == i + 1 and len(buf) - at > CHUNK_BYTES:
            end = at + CHUNK_BYTES
            while end < len(buf):
                hit = np.flatnonzero(gap[buf[end:end + CHUNK_BYTES]])
                if len(hit):
                    end += int(hit[0])
                    break
                end = min(end + CHUNK_BYTES, len(buf))
            yield i, buf[at:end], np.array([0, end - at]), end < len(buf)
            at = end
        if at < len(buf) or at == 0:
            yield i, buf[at:], off if at == 0 else np.array([0, len(buf) - at]), False


def word_bounds(buf: np.ndarray, off: np.ndarray,
                gap: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends, and per text the index of its first word (n + 1 entries)."""
    inside = ~gap[buf]
    starts = inside.copy()
    ends = np.empty(len(buf), dtype=bool)
    if len(buf):
        starts[1:] &= ~inside[:-1]
        cut = off[1:-1]
        cut = cut[cut < len(buf)]
        starts[cut] = inside[cut]            # a word never crosses from one text to the next
        ends[:-1] = inside[:-1] & (~inside[1:] | starts[1:])
        ends[-1] = inside[-1]
    s = np.flatnonzero(starts)
    e = np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, off)


def shingles(buf: np.ndarray, off: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of every text in order, per-text offsets into them, and per-text word offsets.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  A text of 1 to
    ``width - 1`` words has its whole sequence as one shingle; one without words has none.
    """
    s, e, first = word_bounds(buf, off)
    w = PrefixHash(buf, lower=True).ranges(s, e)
    n_words = np.diff(first)
    count = np.where(n_words >= width, n_words - width + 1, (n_words > 0).astype(np.int64))
    out_off = np.zeros(len(count) + 1, dtype=np.int64)
    np.cumsum(count, out=out_off[1:])
    if len(w) == 0:
        return np.zeros(0, _U), out_off, first
    full = max(len(w) - width + 1, 0)
    acc = np.zeros(full, dtype=_U)
    for k in range(width):
        acc += mix64(w[k:k + full] * _WORD_MULT[k % 5] + _U(k + 1))
    acc = mix64(acc)
    out = np.empty(out_off[-1], dtype=_U)
    # positions: the word index where each shingle starts
    at = np.arange(out_off[-1], dtype=np.int64) - np.repeat(out_off[:-1] - first[:-1], count)
    short = (n_words > 0) & (n_words < width)
    long_rows = np.repeat(~short, count)
    out[long_rows] = acc[at[long_rows]]
    for i in np.flatnonzero(short):
        seq = w[first[i]:first[i + 1]]
        k = np.arange(len(seq))
        out[out_off[i]] = mix64(np.array([(mix64(seq * _WORD_MULT[k] + (k + 1).astype(_U))).sum(dtype=_U)
                                          + _U(len(seq))], dtype=_U))[0]
    return out, out_off, first


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def save(df: DataFrame, tag: str = "step") -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and continue from the written table."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._llm_path = path
    return out


def save_bucketed(df: DataFrame, key: str, tag: str = "bucketed") -> DataFrame:
    """Like ``save``, as a table bucketed by ``key``: several later joins on it move the other side only."""
    spark = df.sparkSession
    name = f"llm_{tag}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).option("path", scratch_dir(spark, name)).saveAsTable(name)
    out = spark.table(name)
    out._llm_path, out._llm_table = scratch_dir(spark, name), name
    return out


def drop_saved(*tables: DataFrame) -> None:
    """Delete tables made by ``save`` or ``save_bucketed`` that no later step reads."""
    for t in tables:
        path = getattr(t, "_llm_path", None)
        if getattr(t, "_llm_table", None):
            t.sparkSession.sql(f"DROP TABLE {t._llm_table}")
        if path:
            jvm = t.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def bounded_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Hand Arrow batches of at most ``rows`` rows to Python: with whole texts in them the default of
    10,000 rows costs each task some 100 MB on either side.  A smaller setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Shuffle files of every query inside go when the query ends; for steps that go on from written tables."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected edge list: (node, component), component = smallest node.

    Rounds of minimum-neighbour hooking plus pointer jumping, each a join and
    an aggregate with map-side combine; every round's labels are written to the
    shared folder.  Only the count of changed labels reaches the driver.
    """
    both = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = save(both.union(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = save(e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                  .select("node", F.least("node", "m").alias("component")), "cc")
    while True:
        # smallest label among the neighbours' labels, offered to the node and to the root it points at
        near = (e.join(labels.select(F.col("node").alias("v"), F.col("component").alias("lv")), "v")
                .groupBy(F.col("u").alias("node")).agg(F.min("lv").alias("lv")))
        step = labels.join(near, "node").select("node", "component", F.least("component", "lv").alias("low"))
        offers = (step.select("node", "low").unionByName(step.select(F.col("component").alias("node"), "low"))
                  .groupBy("node").agg(F.min("low").alias("low")))
        hooked = save(labels.join(offers, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "low").alias("component")), "cc")
        jump = hooked.select(F.col("node").alias("component"), F.col("component").alias("up"))
        new = save(hooked.join(jump, "component").select(
            "node", F.least("component", "up").alias("component"), "old"), "cc")
        changed = new.where("component <> old").limit(1).count()
        drop_saved(labels, hooked)
        labels = new
        if not changed:
            drop_saved(e)
            out = new.select("node", "component")
            out._llm_path = new._llm_path
            return out
