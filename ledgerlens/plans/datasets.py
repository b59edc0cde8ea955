"""Dataset assembly chains: v1 (latest record + base features + label), v2 and v3."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.config import FeatureConfig, FeatureConfigExtended, FeatureConfigExtendedV2
from ledgerlens.operators.assemble import join_labels_left, latest_record
from ledgerlens.operators.schema import (harmonize_dtypes, impute_sentinel, prune_features,
                                         sanitize_dtypes)
from ledgerlens.plans.features import features_base, features_v1, features_v2
from ledgerlens.session import materialize as _materialize

# Settings of the v3 run: legacy single decay 0.88 and a 10-quantile utilisation band.
V3_CONFIG = FeatureConfigExtendedV2(time_decay=0.88, time_decays=(0.88, 0.95, 0.70),
                                    momentum_windows=(6, 12, 24), risk_band_bins=10)


def ids_first(df: DataFrame, first: Sequence[str] = ("id", "rn", "target")) -> DataFrame:
    head = [c for c in first if c in df.columns]
    return df.select(*head, *[c for c in df.columns if c not in head])


def dataset_v1(products: DataFrame, labels: DataFrame, tiebreak: Sequence[str] = (),
               cfg: FeatureConfig = FeatureConfig(), materialize: bool = True) -> DataFrame:
    """Latest product per borrower -> base features -> default label -> stable types.

    ``materialize`` writes the latest-record table once (shared checkpoint
    folder) so the type-range pass and the final plan do not both redo the
    shuffle over all product rows.
    """
    latest = latest_record(products, tiebreak=tiebreak)
    if materialize:
        latest = _materialize(latest)
    feat = features_base(latest, cfg)
    lab = join_labels_left(feat, labels)
    paym = [c for c in lab.columns if c.startswith("enc_paym_")]
    typed = lab.withColumns({c: F.col(c).cast("short") for c in paym}) if paym else lab
    typed = harmonize_dtypes(typed, managed=paym + ["target"])
    return ids_first(typed)


def dataset_v2(v1: DataFrame, cfg: FeatureConfigExtended = FeatureConfigExtended(),
               materialize: bool = True) -> DataFrame:
    """v1 -> extended features -> recency sentinel -> pruning."""
    out = features_v1(_materialize(v1) if materialize else v1, cfg)
    out = impute_sentinel(out)
    return ids_first(prune_features(out))


def dataset_v3(v1: DataFrame, cfg_v1: FeatureConfigExtended = FeatureConfigExtended(),
               cfg_v2: FeatureConfigExtendedV2 = V3_CONFIG, materialize: bool = True) -> DataFrame:
    """v1 -> extended features -> sanitised types -> v2 features (same names overwritten)
    -> recency sentinel -> pruning (util_x_overdue dropped too).

    Five statistics passes (two cap sets, type ranges, band edges) read the
    v1 table, so it is written once first when ``materialize``.
    """
    out = features_v1(_materialize(v1) if materialize else v1, cfg_v1)
    out = sanitize_dtypes(out, skip=("id", "rn", "target"))
    out = features_v2(out, cfg_v2)
    out = impute_sentinel(out)
    return ids_first(prune_features(out, drop_util_x_overdue=True))
