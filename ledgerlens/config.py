"""Frozen configuration objects for the feature builders.

Field names follow the builders' public options so a user can carry their
settings over unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Dict, Optional, Tuple

# Fixed values that must match for equal results.
# Payment status codes: OK = 0, 1; LATE = 2..9; anything else (and null) is neither.
PAYM_OK_VALUES: Tuple[int, ...] = (0, 1)
PAYM_LATE_VALUES: Tuple[int, ...] = (2, 3, 4, 5, 6, 7, 8, 9)
# Delinquency bucket weights used by the severity score.
BUCKET_WEIGHTS: Tuple[Tuple[str, int], ...] = (
    ("pre_loans5", 1),
    ("pre_loans530", 2),
    ("pre_loans3060", 3),
    ("pre_loans6090", 4),
    ("pre_loans90", 5),
)
# Sources of the ratios to the credit limit, and their output names.
TO_LIMIT: Tuple[Tuple[str, str], ...] = (
    ("pre_loans_total_overdue", "overdue_to_limit"),
    ("pre_loans_max_overdue_sum", "maxover_to_limit"),
    ("pre_loans_outstanding", "outstanding_to_limit"),
    ("pre_loans_next_pay_summ", "nextpay_to_limit"),
)
# Zero flags that together mean "no 30+ days overdue".
ZERO_30PLUS: Tuple[str, ...] = ("is_zero_loans3060", "is_zero_loans6090", "is_zero_loans90")
# Tie-break columns for several rows with the same (id, rn).
TIE_BREAK_COLS: Tuple[str, ...] = ("pre_since_opened", "pre_since_confirmed", "pre_fterm")
# Recency sentinel: 25 history slots, "never" = 25.
RECENCY_SENTINEL: float = 25.0
# Alternative id column names, in order of preference.
ID_CANDIDATES: Tuple[str, ...] = ("ID", "Id", "client_id", "customer_id", "loan_id",
                                  "account_id", "user_id", "uid")


@dataclass(frozen=True)
class FeatureConfig:
    """Base builder: last status, clean streak, one-hot of categorical columns."""

    cat_cols: Tuple[str, ...] = ()
    ohe_prefix: str = "OHE"
    paym_cols: Optional[Tuple[str, ...]] = None
    verbose: bool = False


@dataclass(frozen=True)
class FeatureConfigExtended(FeatureConfig):
    """v1 extended builder."""

    use_payment_seq: bool = True
    use_ratios: bool = True
    use_bucket_severity: bool = True
    use_interactions: bool = True
    windows: Tuple[int, ...] = (3, 6, 12, 24)
    cap_outliers: bool = True
    cap_bounds: Dict[str, Tuple[float, float]] = field(
        default_factory=lambda: {"_default": (1.0, 99.0)})
    eps: float = 1e-4
    paym_ok_values: Tuple[int, ...] = PAYM_OK_VALUES
    paym_late_values: Tuple[int, ...] = PAYM_LATE_VALUES
    # exact percentiles for the caps; False = percentile_approx with this accuracy
    exact_caps: bool = True
    approx_accuracy: int = 100_000


@dataclass(frozen=True)
class FeatureConfigExtendedV2(FeatureConfigExtended):
    """v2 builder: fourteen ordered, toggled groups."""

    use_momentum: bool = True
    use_cross_ratios: bool = True
    use_behavioral_flags: bool = True
    use_age_exposure: bool = True
    use_interaction_grid: bool = True
    momentum_windows: Tuple[int, ...] = (6, 12, 24)
    time_decays: Tuple[float, ...] = (0.88, 0.95, 0.70)
    risk_band_bins: int = 0
    use_payment_transitions: bool = True
    use_outstanding_ratios: bool = True
    use_zero_aggregates: bool = True
    use_logs: bool = True
    use_time_decay: bool = True
    time_decay: float = 0.85
    # True reproduces the uint8 wrap-around of the original transition count
    # (a 1 -> 0 step counts 255); False counts switches.
    compat_uint8: bool = False
