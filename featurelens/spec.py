"""Column roles of a modelling table."""

from __future__ import annotations

from dataclasses import dataclass

from featurelens.functions.constants import (
    DEFAULT_DATE_KEYS, DEFAULT_PRIMARY_KEYS, CATEGORICAL_FILL, NUMERICAL_FILL,
)


@dataclass(frozen=True)
class FeatureSpec:
    cust_key: str = "cif_id"
    pkeys: tuple = DEFAULT_PRIMARY_KEYS
    dkeys: tuple = DEFAULT_DATE_KEYS
    label: str = "label"
    drop_cols: tuple = ("col",)
    date_col: str = "date"
    numerical_fill: float = NUMERICAL_FILL
    categorical_fill: str = CATEGORICAL_FILL

    def non_features(self) -> set:
        return set(self.pkeys) | set(self.dkeys) | {self.label, self.cust_key, self.date_col}
