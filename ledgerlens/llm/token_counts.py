"""Token counts of whole texts with a two-tier map-side lookup.

A byte-level BPE tokenizer splits a text into pre-tokens and encodes each on
its own, so a text's token count is the sum of its pre-tokens' counts.

1. ``frequent_lengths``: every task counts the pre-tokens of all its rows and
   hands out its ``per_task`` most frequent ones; the sums of these short lists
   are ranked and the first ``table_rows`` become the broadcast table: sorted
   64-bit fingerprints and one length each (10 bytes an entry, at most 640 KB at
   the defaults, whatever the corpus).  The table decides speed, never a count.
2. ``count_tokens``: one map over the rows.  Pre-tokens are found and
   fingerprinted with vectorised passes, looked up in the broadcast table, then
   in a per-worker cache; what misses both is encoded once per worker.  The
   cache is emptied at ``cache_rows`` entries.  Neither texts nor their
   pre-tokens are shuffled.

Fingerprints are 64 bits wide over the pre-token's bytes and length.  Texts
holding a special string are encoded by the library as they are, so the
library's own rule for it holds.  Null or empty text: 0 bytes, 0 tokens.
Repeated rows give repeated rows, an empty table an empty result; other columns
are ignored.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import PrefixHash, chunks

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
_WORKER: dict = {}       # per Python worker: tokenizer, character classes and the miss cache


def _byte_chars() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


def _piece_encoder(spec: dict, tok):
    """bytes of one pre-token -> number of tokens.

    Where the vocabulary's ids follow the merge order (checked), the merges are
    replayed from the same file by a rank encoder, which has no per-call
    overhead; any other vocabulary goes through the library.
    """
    import tiktoken
    model, back = spec["model"], _byte_chars()
    merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    vocab = model["vocab"]
    if all(vocab.get(m) == 256 + i for i, m in enumerate(merges)) and len(vocab) == 256 + len(merges):
        ranks = {bytes(back[c] for c in t): i for t, i in vocab.items()}
        enc = tiktoken.Encoding("ranks", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={})
        return lambda piece: len(enc._encode_single_piece(piece)) if len(piece) > 1 else 1
    return lambda piece: len(tok.encode(piece.decode(), add_special_tokens=False))


def _worker(path: str) -> dict:
    if _WORKER.get("path") != path:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
            raise ValueError("count_tokens needs a byte-level tokenizer without normalizer and prefix space")
        tok = Tokenizer.from_file(path)
        cls = np.full(0x110000, OTHER, dtype=np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for pattern, code in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
            for m in regex.finditer(pattern, every):
                a, b = ord(every[m.start()]), ord(every[m.end() - 1])
                cls[a:b + 1] = code
        _WORKER.update(path=path, tok=tok, cls=cls, cache={}, length=_piece_encoder(spec, tok),
                       special=[t["content"].encode() for t in spec.get("added_tokens", [])])
    return _WORKER


def pretoken_starts(cp: np.ndarray, new: np.ndarray, cls: np.ndarray) -> np.ndarray:
    """Mask of the code points where a pre-token starts.

    cp: code points of consecutive texts; new: mask of each text's first one.
    A pre-token is a run of letters, of numbers or of other signs with at most
    one leading blank; the apostrophe endings s, t, m, d, re, ve, ll; or white
    space (a run before a word leaves its last character to itself or to that word).
    """
    n = len(cp)
    k = cls[cp]
    start = new.copy()
    start[1:] |= k[1:] != k[:-1]
    blank = k == SPACE
    last = np.zeros(n, dtype=bool)                       # last white space before a word of the same text
    last[:-1] = blank[:-1] & ~blank[1:] & ~new[1:]
    begins = start & ~blank
    begins[1:] &= ~(last[:-1] & (cp[:-1] == 0x20))       # its leading blank starts the pre-token
    out = (start & blank) | last | begins
    quote = np.flatnonzero((cp == 0x27) & begins)
    if len(quote):
        pad = np.concatenate([cp, np.zeros(3, cp.dtype)])
        edge = np.concatenate([new, np.ones(3, bool)])
        a, b = pad[quote + 1], pad[quote + 2]
        one = ~edge[quote + 1] & np.isin(a, [ord(c) for c in "stmd"])
        two = ~edge[quote + 1] & ~edge[quote + 2] & (
            ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l")))
        for hit, width in ((one, 2), (two, 3)):
            q = quote[hit]
            out[q + 1] = False
            if width == 3:
                out[q + 2] = False
            q = q + width
            out[q[q < n]] = True
    return out


def _chunk_tokens(w: dict, buf: np.ndarray, off: np.ndarray):
    """Byte starts and ends of the pre-tokens of a chunk and their fingerprints."""
    cp = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    at = np.flatnonzero((buf & 0xC0) != 0x80)            # byte offset of each code point
    new = np.zeros(len(buf) + 1, dtype=bool)
    new[off[:-1]] = True
    s = at[pretoken_starts(cp, new[at], w["cls"])]
    e = np.append(s[1:], len(buf))
    return s, e, PrefixHash(buf).ranges(s, e)


def frequent_lengths(df: DataFrame, tokenizer_path: str, per_task: int = 4096,
                     table_rows: int = 65536, max_pretoken: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints and lengths of at most ``table_rows`` frequent pre-tokens of column ``text``."""

    def tally(batches):
        w = _worker(tokenizer_path)
        seen: dict[bytes, int] = {}
        for batch in batches:
            for _, _, buf, off in chunks(batch.column(0)):
                if not len(buf):
                    continue
                s, e, h = _chunk_tokens(w, buf, off)
                _, first, count = np.unique(h, return_index=True, return_counts=True)
                keep = np.flatnonzero((count > 1) & (e[first] - s[first] <= max_pretoken))
                raw = buf.tobytes()
                for a, b, c in zip(s[first[keep]].tolist(), e[first[keep]].tolist(), count[keep].tolist()):
                    p = raw[a:b]
                    seen[p] = seen.get(p, 0) + c
            if len(seen) > 64 * per_task:                # keep the task's memory bounded
                seen = dict(sorted(seen.items(), key=lambda x: -x[1])[:16 * per_task])
        top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:per_task]
        if top:
            yield pa.RecordBatch.from_pydict({"p": [p for p, _ in top], "c": [c for _, c in top]})

    rows = (df.select("text").mapInArrow(tally, "p binary, c long")
            .groupBy("p").agg(F.sum("c").alias("c"))
            .orderBy(F.desc("c"), "p").limit(table_rows).select("p").collect())
    w = _worker(tokenizer_path)
    words = [bytes(r.p) for r in rows]
    buf = np.frombuffer(b"".join(words), dtype=np.uint8)
    end = np.cumsum([len(x) for x in words], dtype=np.int64)
    h = PrefixHash(buf).ranges(end - np.array([len(x) for x in words], np.int64), end)
    order = np.argsort(h)
    return h[order], np.array([w["length"](x) for x in words], dtype=np.int16)[order]


def count_tokens(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 512, cache_rows: int = 400_000, **table) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row of ``df``."""
    spark = df.sparkSession
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(frequent_lengths(src, tokenizer_path, **table))

    def lengths(w, buf, s, e, h):
        keys, known = shared.value
        out = np.zeros(len(h), dtype=np.int64)
        miss = np.ones(len(h), dtype=bool)
        if len(keys):
            i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            miss = keys[i] != h
            out[~miss] = known[i[~miss]]
        where = np.flatnonzero(miss)
        if len(where):
            cache, length = w["cache"], w["length"]
            if len(cache) > cache_rows:
                cache.clear()
            u, first, back = np.unique(h[where], return_index=True, return_inverse=True)
            raw, val = buf.tobytes(), []
            for key, a, b in zip(u.tolist(), s[where[first]].tolist(), e[where[first]].tolist()):
                k = cache.get(key)
                if k is None:
                    k = cache[key] = length(raw[a:b])
                val.append(k)
            out[where] = np.array(val, dtype=np.int64)[back]
        return out

    def run(batches):
        w = _worker(tokenizer_path)
        for batch in batches:
            n_bytes, n_tokens = [], []
            for _, _, buf, off in chunks(batch.column(1)):
                total = np.zeros(len(off) - 1, dtype=np.int64)
                if len(buf):
                    s, e, h = _chunk_tokens(w, buf, off)
                    run_sum = np.concatenate([[0], np.cumsum(lengths(w, buf, s, e, h))])
                    total = np.diff(run_sum[np.searchsorted(s, off)])
                    raw = buf.tobytes()
                    if any(x in raw for x in w["special"]):
                        for i in range(len(off) - 1):
                            text = raw[off[i]:off[i + 1]]
                            if any(x in text for x in w["special"]):
                                total[i] = len(w["tok"].encode(text.decode(), add_special_tokens=False))
                n_bytes.append(np.diff(off))
                n_tokens.append(total)
            if n_bytes:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.concatenate(n_bytes)), pa.array(np.concatenate(n_tokens))],
                    names=["id", "n_bytes", "n_tokens"])

    kind = src.schema["id"].dataType.simpleString()
    return (src.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                    (F.col("n_tokens") > limit).alias("over_limit")))
