"""Quantile band of the utilisation proxy (``qcut`` semantics, duplicate edges dropped)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.quantiles import quantile_table


def util_source(columns) -> str | None:
    if "pre_util" in columns:
        return "pre_util"
    if "outstanding_to_limit" in columns:
        return "outstanding_to_limit"
    return None


def band_edges(df: DataFrame, col: str, bins: int, exact: bool = True) -> list[float]:
    probs = [i / bins for i in range(bins + 1)]
    q = quantile_table(df.select(col), [col], probs, exact=exact)
    vals = sorted({r["value"] for r in q.collect() if r["value"] is not None})
    return vals


def band_expr(value, edges: list[float]):
    """Label = number of interior edges strictly below the value (right-closed bins)."""
    interior = edges[1:-1]
    if not interior:
        return F.when(value.isNotNull(), F.lit(0))
    arr = F.array(*[F.lit(float(e)) for e in interior])
    return F.when(value.isNotNull(), F.size(F.filter(arr, lambda e: e < value)))


def util_band(df: DataFrame, bins: int, lower: float = 0.0, upper: float = 5.0,
              exact: bool = True) -> DataFrame:
    src = util_source(df.columns)
    if src is None:
        return df
    u = F.col(src).cast("float")
    clipped = F.when(u.isNotNull(), F.least(F.greatest(u, F.lit(lower).cast("float")),
                                            F.lit(upper).cast("float"))).cast("double")
    probe = df.select(clipped.alias("_u"))
    edges = band_edges(probe, "_u", bins, exact)
    if not edges:
        return df.withColumn(f"util_band_q{bins}", F.lit(None).cast("short"))
    return df.withColumn(f"util_band_q{bins}", band_expr(clipped, edges).cast("short"))
