"""Exact, linearly interpolated percentiles by selection between sketch brackets.

``percentile(c, p)`` buffers every distinct value of a column in one task, and
sorting all values moves rows x columns.  Here a mergeable sketch
(``percentile_approx``: every task sketches its rows, sketches are merged) brackets
each wanted rank between two values a little below and above it.  A second pass
counts the values below each bracket and moves only those inside it, counted per
value before the shuffle; these are ranked by running totals, and the two values around the
rank are picked.  A rank that its bracket misses is bracketed again, wider, so the
result is exact whatever the sketch's error.  NULL and NaN are skipped, like ``nanpercentile``.
"""

from __future__ import annotations

import math
from functools import reduce
from typing import Dict, List, Sequence, Tuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.cumulative import running_totals

SKETCH = 10_000          # the sketch's rank error is at most rows / SKETCH
Key = Tuple[int, float]  # (column number, probability)


def _clean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Columns c0, c1, ... as doubles, NaN as NULL."""
    return df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(cols)])


def _sql(x: float) -> str:
    return f"({float(x)!r}D)" if math.isfinite(x) else f"CAST('{x}' AS DOUBLE)"


def brackets(clean: DataFrame, keys: Sequence[Key], slack: float) -> Tuple[Dict[int, int], Dict[Key, Tuple[float, float]]]:
    """(values per column, key -> (low, high)) from one sketch per column; columns without values have no keys."""
    by_col: Dict[int, List[float]] = {}
    for i, p in keys:
        by_col.setdefault(i, []).append(p)
    aggs = []
    for i, ps in by_col.items():
        at = [x for p in ps for x in (max(0.0, p - slack), min(1.0, p + slack))]
        aggs += [F.count(f"c{i}").alias(f"n{i}"), F.percentile_approx(f"c{i}", at, SKETCH).alias(f"q{i}")]
    row = clean.agg(*aggs).first()                        # 1 + 2 x probabilities numbers per column
    n = {i: row[f"n{i}"] for i in by_col}
    out = {}
    for i, ps in by_col.items():
        for k, p in enumerate(ps):
            if n[i]:
                low, high = row[f"q{i}"][2 * k:2 * k + 2]
                out[i, p] = (-math.inf if p <= slack else low, math.inf if p >= 1.0 - slack else high)
    return n, out


def inside(clean: DataFrame, at: Sequence[Tuple[Key, Tuple[float, float]]]) -> DataFrame:
    """(key, v): the values within each bracket; key numbers the brackets."""
    each = [f"CASE WHEN c{i} >= {_sql(low)} AND c{i} <= {_sql(high)} THEN named_struct('key', {k}, 'v', c{i}) END"
            for k, ((i, _), (low, high)) in enumerate(at)]
    return clean.select(F.expr(f"inline(filter(array({', '.join(each)}), x -> x IS NOT NULL))"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    n_parts: int | None = None) -> DataFrame:
    """One row per (column, p) with the interpolated value (numpy 'linear' rule); none for a column without values."""
    from ledgerlens.session import materialize
    clean = _clean(df, cols)
    todo: List[Key] = [(i, float(p)) for i in range(len(cols)) for p in dict.fromkeys(probs)]
    slack, parts = 2.0 / SKETCH, []
    while todo:
        n, found = brackets(clean, todo, slack)
        at = list(found.items())
        if not at:
            break
        counts = materialize(inside(clean, at).groupBy("key", "v").agg(F.count(F.lit(1)).alias("c")))
        below = clean.agg(*[F.expr(f"count_if(c{i} < {_sql(low)})").alias(str(k))
                            for k, ((i, _), (low, _)) in enumerate(at)]).first()
        held = {r.key: r.c for r in counts.groupBy("key").agg(F.sum("c").alias("c")).collect()}
        picks, todo = [], []
        for k, ((i, p), _) in enumerate(at):
            h = p * (n[i] - 1)
            if below[k] <= math.floor(h) and math.ceil(h) < below[k] + held.get(k, 0):
                picks += [(k, cols[i], p, h, side, int(r) - below[k]) for side, r in enumerate((math.floor(h), math.ceil(h)))]
            else:
                todo.append((i, p))
        if picks:
            ranked = running_totals(counts, "v", ["c"], ["key"], n_parts=n_parts).select(
                F.col("key").alias("k"), "v", (F.col("cum_c") - F.col("c")).alias("lo_r"), F.col("cum_c").alias("hi_r"))
            # the value whose rank span [lo_r, hi_r) holds r; picks has 2 x #cols x #probs rows
            wanted = F.broadcast(df.sparkSession.createDataFrame(picks, "key int, column string, p double, h double, side int, r long"))
            parts.append(ranked.join(wanted, (F.col("k") == F.col("key")) & (F.col("lo_r") <= F.col("r")) & (F.col("r") < F.col("hi_r"))))
        slack *= 16
    if not parts:
        return df.sparkSession.createDataFrame([], "column string, p double, value double")
    both = reduce(DataFrame.unionByName, parts).groupBy("column", "p").agg(
        F.max("h").alias("h"), F.max(F.when(F.col("side") == 0, F.col("v"))).alias("a"),
        F.max(F.when(F.col("side") == 1, F.col("v"))).alias("b"))
    frac = F.col("h") - F.floor("h")
    diff = F.col("b") - F.col("a")
    value = F.when(frac >= 0.5, F.col("b") - diff * (F.lit(1.0) - frac)).otherwise(F.col("a") + diff * frac)
    return both.select("column", "p", value.alias("value"))


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     accuracy: int = 100_000) -> DataFrame:
    aggs = [F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                                list(probs), accuracy).alias(c) for c in cols]
    row = df.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("vals")) for c in cols])
    return (row.select(F.explode(arr).alias("x"))
            .select("x.column", F.posexplode("x.vals").alias("i", "value"))
            .select("column", F.element_at(F.array(*[F.lit(float(p)) for p in probs]), F.col("i") + 1)
                    .alias("p"), "value"))


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   exact: bool = True, accuracy: int = 100_000) -> DataFrame:
    """Exact quantiles by the distributed rank join, one way for every size; ``exact=False``: ``percentile_approx``."""
    return exact_quantiles(df, cols, probs) if exact else approx_quantiles(df, cols, probs, accuracy)


def percentile_caps(df: DataFrame, cols: Sequence[str],
                    bounds: Dict[str, Tuple[float, float]] | None = None,
                    exact: bool = True, accuracy: int = 100_000) -> Dict[str, Tuple[float, float]]:
    """Per column (lo, hi) = (p_lo, p_hi)-th percentiles, default (1, 99).

    The result has two numbers per column, so it is brought to the driver and
    inlined as literals in the capping projection.
    """
    bounds = bounds or {"_default": (1.0, 99.0)}
    default = bounds.get("_default", (1.0, 99.0))
    out: Dict[str, Tuple[float, float]] = {}
    by_bounds: Dict[Tuple[float, float], list] = {}
    for c in cols:
        by_bounds.setdefault(tuple(bounds.get(c, default)), []).append(c)
    for (p_lo, p_hi), group in by_bounds.items():
        q = quantile_table(df, group, [p_lo / 100.0, p_hi / 100.0], exact, accuracy)
        got = {(r["column"], round(r["p"], 12)): r["value"] for r in q.collect()}
        for c in group:
            lo = got.get((c, round(p_lo / 100.0, 12)))
            hi = got.get((c, round(p_hi / 100.0, 12)))
            out[c] = (lo, hi)
    return out


def clip(c, lo, hi):
    """Clip keeping NULL (``greatest``/``least`` alone would skip a NULL input)."""
    if lo is None or hi is None:
        return c
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))
