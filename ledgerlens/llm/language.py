"""Language identification by multilingual mixture inference.

``train`` counts letter trigrams (with word edges) per labelled language over all
training rows, hashed into ``2 ** BITS`` buckets.  A task hands out at most one
row per (language, bucket); the summed table, languages x buckets, is all that
reaches the driver.

``identify`` takes a text as draws from a mixture of the languages' trigram
distributions.  Expectation-maximisation estimates the proportions; languages
are then added in order of their proportion as long as the log-likelihood gains
more than ``penalty * log(n) / 2`` each, n being the text's number of trigrams.
Proportions are then estimated anew over the selected languages alone: the prediction
is the one with the largest, its score that proportion.  ``fit`` is the text's
log-likelihood per trigram under this mixture less that of drawing all buckets
alike: below 0 no mixture of learned languages explains the text better than chance.

Defined cases: null text or one without letters is ``und`` with score 0; so is
every text when nothing was learned; equal proportions go to the earlier language
by code point; repeated rows give repeated rows; empty tables empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import mix64

BITS = 15
UNKNOWN = "und"
MAX_LANGUAGES = 512      # the broadcast model holds 2^15 numbers of 8 bytes for each: 128 MB at most
_LETTER: list[np.ndarray] = []


def held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by 5 (null id: not held out, and not learned from)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _is_letter() -> np.ndarray:
    if not _LETTER:
        table = np.zeros(0x110000, dtype=bool)
        table[[c for c in range(0x110000) if chr(c).isalpha()]] = True
        _LETTER.append(table)
    return _LETTER[0]


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased words, one blank before, between and after; empty without letters."""
    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    is_letter = _is_letter()[cp]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    if not is_letter.any():
        return np.zeros(0, dtype=np.uint32)
    seq = np.where(is_letter, cp, 32)[keep]
    return np.concatenate([[32], seq, [32] if seq[-1] != 32 else []]).astype(np.uint64)


def trigrams(text: str) -> np.ndarray:
    s = letters(text)
    if len(s) < 3:
        return np.zeros(0, dtype=np.int64)
    code = (s[:-2] << np.uint64(42)) | (s[1:-1] << np.uint64(21)) | s[2:]
    return (mix64(code) >> np.uint64(64 - BITS)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray        # languages x buckets


def train(df: DataFrame, text_col: str = "text", lang_col: str = "lang", smooth: float = 0.5) -> Model:
    """Fit on all rows of ``df`` that have a language."""
    size = 1 << BITS

    def tally(batches):
        seen: dict[str, np.ndarray] = {}
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if lang not in seen:
                    seen[lang] = np.zeros(size, dtype=np.int64)
                seen[lang] += np.bincount(trigrams(text or ""), minlength=size)
        for lang, count in seen.items():
            at = np.flatnonzero(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(count[at])],
                names=["lang", "bucket", "n"])

    rows = (df.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
            .mapInArrow(tally, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    names = sorted(rows.lang.unique())
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; the broadcast model is bounded at {MAX_LANGUAGES}")
    table = np.full((len(names), size), smooth)
    place = {x: i for i, x in enumerate(names)}
    table[rows.lang.map(place).to_numpy(dtype=int), rows.bucket.to_numpy(dtype=int)] += rows.n.to_numpy()
    return Model(names, np.log(table / table.sum(axis=1, keepdims=True)) if names else table)


def _em(p: np.ndarray, c: np.ndarray, start: np.ndarray, rounds: int) -> tuple[np.ndarray, float]:
    """Proportions and log-likelihood of counts ``c`` under the mixture of the rows of ``p``."""
    pi, n = start, c.sum()
    for _ in range(rounds):
        new = pi * (p @ (c / (pi @ p))) / n
        done = np.abs(new - pi).max() < 1e-4
        pi = new
        if done:
            break
    return pi, float(c @ np.log(pi @ p))


def mixture(model: Model, text: str, **how) -> tuple[list[int], np.ndarray] | None:
    """Indices of the selected languages and their proportions, largest first; None: no letters."""
    found = explain(model, text, **how)
    return found and found[:2]


def explain(model: Model, text: str, rounds: int = 30,
            penalty: float = 8.0) -> tuple[list[int], np.ndarray, float, int] | None:
    """(selected languages, their proportions, fit, trigrams), largest proportion first; None: no letters."""
    grams = trigrams(text)
    if not len(grams) or not model.languages:
        return None
    u, c = np.unique(grams, return_counts=True)
    c = c.astype(float)
    p = np.exp(model.log_p[:, u])
    k = len(p)
    pi, best = _em(p, c, np.full(k, 1 / k), rounds)
    order = np.lexsort((np.arange(k), -pi))
    cost = penalty * np.log(c.sum() + 1) / 2
    chosen = [int(order[0])]
    share, ll = _em(p[chosen], c, np.ones(1), rounds)
    for nxt in order[1:]:
        if best - ll <= cost:                  # not even all languages together gain enough
            break
        trial = [*chosen, int(nxt)]
        more, gain = _em(p[trial], c, np.full(len(trial), 1 / len(trial)), rounds)
        if gain - ll <= cost:
            break
        chosen, share, ll = trial, more, gain
    by = np.lexsort((chosen, -share))
    return [chosen[i] for i in by], share[by], ll / c.sum() + np.log(model.log_p.shape[1]), int(c.sum())


def identify(df: DataFrame, model: Model, text_col: str = "text", prefix: str = "", **how) -> DataFrame:
    """``df`` with lang_pred, score, langs and shares (the selected languages and their proportions), fit and n_grams.

    The new columns' names start with ``prefix``; columns of ``df`` with the same names go.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    new = [prefix + x for x in ("lang_pred", "score", "langs", "shares", "fit", "n_grams")]
    names = [n for n in df.columns if n not in new]
    src = df.select(*names)
    extra = pa.schema([("lang_pred", pa.string()), ("score", pa.float64()),
                       ("langs", pa.list_(pa.string())), ("shares", pa.list_(pa.float64())),
                       ("fit", pa.float64()), ("n_grams", pa.int64())])

    def run(batches):
        m = shared.value
        for b in batches:
            rows = []
            for text in b.column(names.index(text_col)).to_pylist():
                found = explain(m, text, **how) if text else None
                if found is None:
                    rows.append({"lang_pred": UNKNOWN, "score": 0.0, "langs": [], "shares": [], "fit": 0.0, "n_grams": 0})
                    continue
                chosen, pi, fit, n = found
                share = [float(min(1.0, max(0.0, x))) for x in pi]
                rows.append({"lang_pred": m.languages[chosen[0]], "score": share[0], "langs": [m.languages[i] for i in chosen],
                             "shares": share, "fit": float(fit), "n_grams": n})
            if rows:
                more = pa.RecordBatch.from_pylist(rows, schema=extra)
                yield pa.RecordBatch.from_arrays([*b.columns, *more.columns], names=[*names, *new])

    from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructType
    out = StructType(list(src.schema.fields))
    for name, kind in zip(new, (StringType(), DoubleType(), ArrayType(StringType()), ArrayType(DoubleType()), DoubleType(), LongType())):
        out = out.add(name, kind)
    return src.mapInArrow(run, out)
