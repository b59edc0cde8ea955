"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

``document_stats`` describes a text by some twenty numbers (lengths, shares of
character classes, words carrying signs, repetition of words and lines).  Random
Fourier features z(x) = sqrt(2 / D) cos(W x + b) of the standardised numbers
approximate the Gaussian kernel exp(-|x - y|^2 / (2 d)), d being their number.

Fitting: every task of the training rows sums its own z z' and z y per fold; the
tasks' sums are added up by matrix row, and D x D numbers per fold reach the
driver.  The folds' sums give the ridge weights of all rows, and by subtraction
those without one fold, so the penalty and the calibration are chosen on
out-of-fold scores without further passes.  Isotonic regression maps the raw
score to the share of good documents; it is fitted on the counts of a grid of
``GRID`` raw scores (values beyond its ends count at the ends), which bounds it.

All labelled rows are used; texts are read whole, in pieces of some 512 KB.

Defined cases: null text is an empty text; a text without words has zeros for
shares; labels without id or quality are left out, several labels of an id weigh
in with their number; rows without id are scored but not learned from; labels of
one kind give that kind's share as every score, no labels give 0.5; repeated rows
get equal scores; an empty table gives an empty result; extra columns of the
document table are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, StructType

from ledgerlens.llm.common import PrefixHash, joined_raw, mix64, pieces, save, word_bounds
from ledgerlens.llm.language import held_out

STATS = ("log_bytes", "log_words", "log_lines", "word_bytes", "word_bytes_sd", "line_words", "letters", "upper", "digits",
         "blanks", "non_ascii", "signs", "stops", "word_signs", "sign_words", "sign_ends", "number_words", "upper_words",
         "capital_words", "long_words", "distinct_words", "top_word", "distinct_lines", "top_line")
GRID = 2048               # raw scores from -0.5 to 1.5 that the calibration tells apart
FOLDS = 4
PENALTIES = (1e-4, 1e-3, 1e-2, 1e-1, 1.0, 10.0)
_U = np.uint64

# classes of bytes
_CODE = np.arange(256)
UPPER = (_CODE >= 65) & (_CODE <= 90)
DIGIT = (_CODE >= 48) & (_CODE <= 57)
HIGH = _CODE >= 128
LETTER = UPPER | ((_CODE >= 97) & (_CODE <= 122)) | HIGH
BLANK = (_CODE == 32) | ((_CODE >= 9) & (_CODE <= 13))
STOP = np.isin(_CODE, [ord(c) for c in ".,;:?'-"])
SIGN = ~(LETTER | DIGIT | BLANK | STOP)
NEWLINE = _CODE == 10


def _per_text(flag: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
    return np.diff(total[off])


class _Repeats:
    """Counts of hashed words (or lines) per text: distinct ones, and the most frequent one's count."""

    def __init__(self, n: int):
        self.distinct, self.top = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.open: tuple[np.ndarray, np.ndarray] | None = None       # of a text that goes on

    def add(self, row: int, text: np.ndarray, h: np.ndarray, goes_on: bool) -> None:
        key = mix64(h + text.astype(_U) * _U(0x9E3779B97F4A7C15))
        u, at, c = np.unique(key, return_index=True, return_counts=True)
        owner = text[at]
        if goes_on or self.open is not None:                          # one text: merge with its earlier pieces
            if self.open is not None:
                u, where = np.unique(np.concatenate([self.open[0], u]), return_inverse=True)
                c = np.bincount(where, weights=np.concatenate([self.open[1], c])).astype(np.int64)
            self.open = (u, c) if goes_on else None
            owner = np.full(len(u), row)
            if goes_on:
                return
        np.add.at(self.distinct, owner, 1)
        np.maximum.at(self.top, owner, c)


def stats_matrix(col: pa.Array) -> np.ndarray:
    """The numbers of STATS for every text of an Arrow string column."""
    n = len(col)
    sums = {k: np.zeros(n) for k in ("bytes", "letters", "upper", "digits", "blanks", "high", "signs", "stops", "words", "len", "len2",
                                     "word_signs", "sign_words", "sign_ends", "number_words", "upper_words", "capital", "long", "lines")}
    words, lines = _Repeats(n), _Repeats(n)
    tail = None
    for row, buf, off, goes_on in pieces(col):
        rows = slice(row, row + len(off) - 1)
        for k, table in (("letters", LETTER), ("upper", UPPER), ("digits", DIGIT), ("blanks", BLANK), ("high", HIGH), ("signs", SIGN),
                         ("stops", STOP)):
            sums[k][rows] += _per_text(table[buf], off)
        sums["bytes"][rows] += np.diff(off)
        h = PrefixHash(buf, lower=True)
        s, e, first = word_bounds(buf, off)
        text = np.repeat(np.arange(row, row + len(off) - 1), np.diff(first))
        size = (e - s).astype(float)

        def inside(table):                                            # bytes of a class in every word
            total = np.concatenate([[0], np.cumsum(table[buf], dtype=np.int64)])
            return total[e] - total[s]
        signs, upper, letters = inside(SIGN), inside(UPPER), inside(LETTER)
        for k, v in (("words", np.ones(len(s))), ("len", size), ("len2", size ** 2), ("word_signs", signs), ("sign_words", signs > 0),
                     ("sign_ends", SIGN[buf[e - 1]] if len(e) else size), ("number_words", inside(DIGIT) > 0),
                     ("upper_words", (upper == letters) & (letters > 1)), ("capital", UPPER[buf[s]] if len(s) else size), ("long", size > 20)):
            sums[k] += np.bincount(text, weights=v, minlength=n)
        words.add(row, text, h.ranges(s, e), goes_on)
        ls, le, lfirst = word_bounds(buf, off, NEWLINE)
        ltext = np.repeat(np.arange(row, row + len(off) - 1), np.diff(lfirst))
        raw, size = h.raw(ls, le), le - ls
        if tail:                                                      # the line that the last piece of this text ended in
            if len(ls) and ls[0] == 0:
                raw[0], size[0] = joined_raw(*tail, int(raw[0])), size[0] + tail[1]
            else:
                raw, size = np.append(np.array([tail[0]], _U), raw), np.append(tail[1], size)
                ltext = np.append(row, ltext)
            tail = None
        if goes_on and len(le) and le[-1] == len(buf):
            tail = int(raw[-1]), int(size[-1])
            raw, size, ltext = raw[:-1], size[:-1], ltext[:-1]
        sums["lines"] += np.bincount(ltext, minlength=n)
        lines.add(row, ltext, mix64(raw + size.astype(_U)), goes_on)
    per = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    b, w, ln = sums["bytes"], sums["words"], sums["lines"]
    mean = per(sums["len"], w)
    out = [np.log1p(b), np.log1p(w), np.log1p(ln), np.log1p(mean), np.log1p(np.sqrt(np.maximum(per(sums["len2"], w) - mean ** 2, 0))),
           np.log1p(per(w, ln)), per(sums["letters"], b), per(sums["upper"], sums["letters"]), per(sums["digits"], b), per(sums["blanks"], b),
           per(sums["high"], b), per(sums["signs"], b), per(sums["stops"], b), np.log1p(per(sums["word_signs"], w)), per(sums["sign_words"], w),
           per(sums["sign_ends"], w), per(sums["number_words"], w), per(sums["upper_words"], w), per(sums["capital"], w), per(sums["long"], w),
           per(words.distinct.astype(float), w), per(words.top.astype(float), w), per(lines.distinct.astype(float), ln),
           per(lines.top.astype(float), ln)]
    return np.stack(out, axis=1)


def document_stats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, stats) of every row."""
    src = df.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))

    def run(batches):
        for b in batches:
            x = stats_matrix(b.column(2))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["id", "held_out", "stats"])

    schema = StructType([src.schema["id"]]).add("held_out", BooleanType()).add("stats", ArrayType(DoubleType()))
    return src.mapInArrow(run, schema)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray       # stats x D
    phase: np.ndarray
    beta: np.ndarray          # D weights and the intercept
    knots: np.ndarray         # calibration: raw scores, ascending, and their values
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Random Fourier features and a 1 for the intercept."""
        x = np.clip((x - self.mean) / self.scale, -8.0, 8.0)
        d = len(self.phase)
        return np.hstack([np.sqrt(2.0 / d) * np.cos(x @ self.weights + self.phase), np.ones((len(x), 1))])

    def calibrated(self, raw: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(raw, self.knots, self.values), 0.0, 1.0)

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibrated(self.features(x) @ self.beta)


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def normal_equations(train: DataFrame, model: Model, tasks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per fold: z z' and z y summed over all rows (weighted), and the sum of y^2.

    train: (id, stats, ones, n).  Every task emits D + 1 rows per fold, which are added
    up by (fold, matrix row); rows are put in order before, so sums do not depend on the schedule.
    """
    d = len(model.phase) + 1
    shared = train.sparkSession.sparkContext.broadcast(model)
    dealt = (train.withColumn("fold", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int"))
             .repartition(tasks, "id").sortWithinPartitions("id", "stats")
             .select("fold", F.spark_partition_id().alias("part"), "ones", "n", "stats"))

    def tally(batches):
        m, sums, part = shared.value, np.zeros((FOLDS, d, d + 2)), None
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column(1)[0].as_py()
            fold, ones, n = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3))
            z = m.features(_matrix(b.column(4), len(m.mean)))
            for f in range(FOLDS):
                at = fold == f
                zf, nf, of = z[at], n[at].astype(float), ones[at].astype(float)
                sums[f, :, :d] += (zf * nf[:, None]).T @ zf
                sums[f, :, d] += zf.T @ of
                sums[f, 0, d + 1] += of.sum()                        # y^2 = y for 0/1 labels
        if part is not None:
            flat = sums.reshape(FOLDS * d, d + 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(FOLDS * d, part, np.int32)), pa.array(np.arange(FOLDS * d, dtype=np.int32)),
                 pa.ListArray.from_arrays(pa.array(np.arange(FOLDS * d + 1, dtype=np.int32) * (d + 2)), pa.array(flat.ravel()))],
                names=["part", "i", "v"])

    def add(batches):
        total: dict[int, np.ndarray] = {}                            # at most FOLDS * (D + 1) rows of D + 3 numbers
        for b in batches:
            v = _matrix(b.column(2), d + 2)
            for i, row in zip(b.column(1).to_pylist(), v):
                total[i] = total[i] + row if i in total else row.copy()
        for i, row in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([row], pa.list_(pa.float64()))], names=["i", "v"])

    parts = dealt.mapInArrow(tally, "part int, i int, v array<double>")
    rows = (parts.repartition(min(tasks, 16), "i").sortWithinPartitions("i", "part").mapInArrow(add, "i int, v array<double>")
            .collect())                                              # FOLDS * (D + 1) rows whatever the input
    out = np.zeros((FOLDS * d, d + 2))
    for r in rows:
        out[r.i] = r.v
    out = out.reshape(FOLDS, d, d + 2)
    return out[:, :, :d], out[:, :, d], out[:, 0, d + 1]


def ridge(a: np.ndarray, b: np.ndarray, penalty: float) -> np.ndarray:
    """Weights for the summed normal equations; the last one, the intercept, is not penalised."""
    p = np.full(len(b), penalty)
    p[-1] = 1e-9
    return np.linalg.solve(a + np.diag(p), b)


def fit(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", features: int = 192,
        tasks: int = 32, seed: int = 7) -> Model:
    """Fit on the rows of ``stats`` that are not held out and have a label (0 or 1)."""
    spark = stats.sparkSession
    marks = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.sum((F.col(label_col) > 0).cast("long")).alias("ones"),
                                                     F.count("*").alias("n")))
    train = save(stats.where(~F.col("held_out")).join(marks, "id"), "train")
    k = len(STATS)
    cols = [F.element_at("stats", i + 1) for i in range(k)]
    first = train.agg(F.sum("n"), F.sum("ones"), *[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
    rng = np.random.default_rng(seed)
    w = rng.normal(size=(k, features)) / np.sqrt(k)                   # exp(-|x - y|^2 / (2 k))
    phase = rng.uniform(0, 2 * np.pi, features)
    n, ones = first[0] or 0, first[1] or 0
    if ones in (0, n):                                                # nothing to tell apart
        flat = np.array([ones / n if n else 0.5])
        return Model(np.zeros(k), np.ones(k), w, phase, np.zeros(features + 1), np.zeros(1), flat)
    mean, sd = np.array(first[2:2 + k], float), np.array(first[2 + k:], float)
    model = Model(mean, np.where(sd > 1e-9, sd, 1.0), w, phase, np.zeros(features + 1), np.zeros(1), np.zeros(1))
    a, b, yy = normal_equations(train, model, tasks)

    def loss(penalty: float) -> float:                                # squared error of every fold under the others' weights
        total = 0.0
        for f in range(FOLDS):
            beta = ridge(a.sum(0) - a[f], b.sum(0) - b[f], penalty)
            total += yy[f] - 2 * beta @ b[f] + beta @ a[f] @ beta
        return total
    penalty = min(PENALTIES, key=loss)
    model.beta = ridge(a.sum(0), b.sum(0), penalty)
    others = [ridge(a.sum(0) - a[f], b.sum(0) - b[f], penalty) for f in range(FOLDS)]

    shared = spark.sparkContext.broadcast((model, others))

    def out_of_fold(batches):
        m, betas = shared.value
        for t in batches:
            z = m.features(_matrix(t.column(3), len(m.mean)))
            raw = np.einsum("ij,ij->i", z, np.array(betas)[t.column(0).to_numpy(zero_copy_only=False)])
            cell = np.clip(np.floor((raw + 0.5) * (GRID / 2)), 0, GRID - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), t.column(1), t.column(2)], names=["cell", "ones", "n"])

    cells = (train.select(F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int").alias("fold"), "ones", "n", "stats")
             .mapInArrow(out_of_fold, "cell int, ones long, n long")
             .groupBy("cell").agg(F.sum("ones").alias("ones"), F.sum("n").alias("n")))     # at most GRID rows
    from pyspark.ml.regression import IsotonicRegression
    points = cells.select(((F.col("cell") + 0.5) * (2.0 / GRID) - 0.5).alias("raw"),
                          (F.col("ones") / F.col("n")).alias("label"), F.col("n").cast("double").alias("weight"))
    iso = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight").fit(points.coalesce(1))
    model.knots, model.values = iso.boundaries.toArray(), iso.predictions.toArray()
    return model


def score(stats: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``stats``."""
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            s = m.score(_matrix(b.column(2), len(m.mean)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=["id", "held_out", "score", "predicted"])

    schema = StructType(list(stats.select("id", "held_out").schema.fields)).add("score", DoubleType()).add("predicted", IntegerType())
    return stats.mapInArrow(run, schema)


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
             threshold: float = 0.3, **how) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``df``, learned from the labels of ids not held out."""
    stats = save(document_stats(df, id_col, text_col), "stats")
    model = fit(stats, labels, id_col, label_col, **how)
    return score(stats, model, threshold).withColumnRenamed("id", id_col)
