"""Payment-history features as code-generated column arithmetic.

The history ``enc_paym_0 .. enc_paym_{n-1}`` (index 0 = most recent) is first
turned into 0/1 slot columns ``_ok_i`` / ``_late_i`` in one projection; every
feature is then plain arithmetic over those columns (sums, CASE chains, a
running-streak recurrence), which whole-stage code generation compiles into
straight-line code with shared subexpressions.  Measured on 1.2M product rows
this is several times faster than the same features written with array
higher-order functions, whose lambdas run interpreted per element.

``paym_array`` / ``binarize`` keep the array form for callers that want the
0/1 history itself as a value.
"""

from __future__ import annotations

import re
from typing import Dict, Iterable, List, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PAYM_PREFIX = "enc_paym_"
OK_PREFIX, LATE_PREFIX = "_ok_", "_late_"
_SLOT = re.compile(r"^enc_paym_(\d+)$")


def order_paym_cols(columns: Iterable[str], explicit: Sequence[str] | None = None) -> list[str]:
    """History columns, newest slot first.

    Found columns go by slot number, names without one last; a given list keeps
    its own order.  Slot 0 leads either way.
    """
    there = list(columns)
    named = [c for c in explicit if c in set(there)] if explicit else [c for c in there if c.startswith(PAYM_PREFIX)]

    def rank(item: tuple[int, str]) -> tuple:
        place, name = item
        slot = _SLOT.match(name)
        number = int(slot.group(1)) if slot and not explicit else float("inf")
        return name != PAYM_PREFIX + "0", number, place
    return [name for _, name in sorted(enumerate(named), key=rank)]


# ------------------------------------------------------------------ array form
def paym_array(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("int") for c in cols])


def binarize(arr: Column, values: Iterable[int]) -> Column:
    """1 where the status is one of ``values``; null status -> 0."""
    vals = [int(v) for v in values]
    return F.transform(arr, lambda x: F.when(x.isin(*vals), 1).otherwise(0))


# ------------------------------------------------------------------ slot columns
# Expressions are written as SQL text and parsed once per feature on the JVM
# side (``F.expr``): building them from Column objects costs one py4j round
# trip per operator, thousands per feature set.  Double literals carry the
# ``D`` suffix so they stay exact doubles (a bare 0.5 would be a DECIMAL).


def _d(x: float) -> str:
    return f"{float(x)!r}D"


def slot_flags(cols: Sequence[str], ok_values: Iterable[int], late_values: Iterable[int]) -> Dict[str, Column]:
    """``_ok_i`` / ``_late_i`` 0/1 ints per history slot; a NULL status is neither."""
    ok = ",".join(str(int(v)) for v in ok_values)
    late = ",".join(str(int(v)) for v in late_values)
    out: Dict[str, Column] = {}
    for i, c in enumerate(cols):
        out[f"{OK_PREFIX}{i}"] = F.expr(f"CASE WHEN CAST(`{c}` AS INT) IN ({ok}) THEN 1 ELSE 0 END")
        out[f"{LATE_PREFIX}{i}"] = F.expr(f"CASE WHEN CAST(`{c}` AS INT) IN ({late}) THEN 1 ELSE 0 END")
    return out


def _sum_sql(prefix: str, k: int) -> str:
    return "(" + " + ".join(f"{prefix}{i}" for i in range(k)) + ")" if k > 0 else "0"


def window_sum(prefix: str, k: int) -> Column:
    return F.expr(_sum_sql(prefix, k))


def _share_sql(prefix: str, k: int) -> str:
    return f"CAST({_sum_sql(prefix, k)} / {_d(k)} AS FLOAT)"


def share(prefix: str, k: int) -> Column:
    """Mean of the first ``k`` slots; NULL statuses count as 0 (denominator is ``k``)."""
    return F.expr(_share_sql(prefix, k))


def longest_run(prefix: str, horizon: int) -> Column:
    """Longest run of 1s within the first ``horizon`` slots (running-streak recurrence)."""
    cur = [f"{prefix}0"]
    for i in range(1, horizon):
        cur.append(f"(CASE WHEN {prefix}{i} = 1 THEN {cur[-1]} + 1 ELSE 0 END)")
    return F.expr(cur[0] if len(cur) == 1 else "GREATEST(" + ", ".join(cur) + ")")


def first_one(prefix: str, n: int) -> Column:
    """0-based index of the first 1 (the most recent event); NULL if none."""
    whens = " ".join(f"WHEN {prefix}{i} = 1 THEN {i}" for i in range(n))
    return F.expr(f"CASE {whens} ELSE CAST(NULL AS INT) END")


def leading_zero_run(cols: Sequence[str]) -> Column:
    """Count of leading statuses equal to 0; stops at the first other value or NULL."""
    whens = " ".join(f"WHEN NOT (`{c}` <=> 0) THEN {i}" for i, c in enumerate(cols))
    return F.expr(f"CASE {whens} ELSE {len(cols)} END")


def slope(prefix: str, k: int) -> Column:
    """OLS slope of the first ``k`` slots on the index 0..k-1 (index 0 = newest).

    The x-deviations sum to zero, so the y-mean cancels: slope = sum(y_i * dx_i) / sum(dx_i^2).
    A positive slope means the status was better further in the past.
    """
    xm = (k - 1) / 2.0
    dx = [i - xm for i in range(k)]
    denom = sum(d * d for d in dx)
    if denom <= 0:
        return F.lit(0.0).cast("float")
    terms = " + ".join(f"{prefix}{i} * {_d(dx[i])}" for i in range(k))
    return F.expr(f"CAST((0.0D + {terms}) / {_d(denom)} AS FLOAT)")


def switches(prefix: str, k: int, compat_uint8: bool = False) -> Column:
    """Number of 0<->1 changes between neighbouring slots of the first ``k``.

    ``compat_uint8`` counts a 1 -> 0 step (read newest to oldest) as 255, which is
    what an unsigned 8-bit difference produces.
    """
    if compat_uint8:
        steps = [f"(CASE WHEN {prefix}{i} - {prefix}{i - 1} = 1 THEN 1 "
                 f"WHEN {prefix}{i} - {prefix}{i - 1} = -1 THEN 255 ELSE 0 END)" for i in range(1, k)]
    else:
        steps = [f"ABS({prefix}{i} - {prefix}{i - 1})" for i in range(1, k)]
    return F.expr(f"CAST(({' + '.join(steps) if steps else '0'}) AS SMALLINT)")


def bernoulli_std(share_col: Column) -> Column:
    """Population std of a 0/1 window from its share s: sqrt(s * (1 - s))."""
    s = share_col.cast("double")
    return F.sqrt(s * (F.lit(1.0) - s)).cast("float")


def late_std(prefix: str, k: int) -> Column:
    """``bernoulli_std`` of the share of the first ``k`` slots, as one expression."""
    s = f"CAST({_share_sql(prefix, k)} AS DOUBLE)"
    return F.expr(f"CAST(SQRT({s} * (1.0D - {s})) AS FLOAT)")


def any_one(prefix: str, k: int) -> Column:
    return F.expr(f"CAST({_sum_sql(prefix, k)} > 0 AS TINYINT)")


def decay_sum(prefix: str, n: int, d: float, normalize: bool = False, eps: float = 1e-4) -> Column:
    """sum_i x_i * d^i over all ``n`` slots; optionally divided by sum_i d^i + eps."""
    weights = [float(d) ** i for i in range(n)]
    e = "(0.0D + " + " + ".join(f"{prefix}{i} * {_d(w)}" for i, w in enumerate(weights)) + ")"
    if normalize:
        e = f"{e} / {_d(sum(weights) + eps)}"
    return F.expr(f"CAST({e} AS FLOAT)")


def decay_name(d: float) -> str:
    """0.88 -> 088, 0.7 -> 07 (the decimal point is dropped from str(d))."""
    return "paym_late_time_decay_" + str(d).replace(".", "")


def slot_names(n: int) -> List[str]:
    return [f"{OK_PREFIX}{i}" for i in range(n)] + [f"{LATE_PREFIX}{i}" for i in range(n)]
