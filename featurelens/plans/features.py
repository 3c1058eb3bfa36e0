"""Label sets and feature tables built from interactions, snapshots and transactions."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from featurelens.functions.calendar import day_range
from featurelens.functions.constants import AUDIT_COLUMNS, HISTORY_DAYS, LOOKAHEAD_DAYS
from featurelens.operators.calendar import period_columns
from featurelens.operators.columns import (
    cast_decimals, feature_columns, fill_categorical, fill_numeric, half_open_dates, valid_features,
)
from featurelens.operators.encoding import index_categories
from featurelens.operators.joins import join_features, join_mapping, lagged_join
from featurelens.operators.profile import data_summary
from featurelens.operators.sampling import stratified_sample
from featurelens.session import cut_lineage
from featurelens.operators.windows import (
    explode_labels, forward_fill, history_pivot, lookahead_labels,
)


def label_dataset(interactions: DataFrame, mapping: DataFrame, user: str, date_col: str, intent: str,
                  map_left: str, map_right: str, mapped_key: str, start=None, end=None,
                  days: tuple = LOOKAHEAD_DAYS, per_label: int | None = None, seed: int = 111,
                  labels_col: str = "next_7_day_labels") -> DataFrame:
    """Interactions -> look-ahead label sets -> one row per label -> mapped
    to the customer key (unmapped dropped) -> optional per-label sample."""
    x = interactions
    if start is not None and end is not None:
        x = x.where(day_range(date_col, start, end))
    lab = explode_labels(lookahead_labels(x, user, date_col, intent, days, labels_col), labels_col)
    mapped = join_mapping(lab, mapping, map_left, map_right, mapped_key)
    if per_label:
        mapped = stratified_sample(mapped, "label", per_label, seed, [map_left, "date", "label"])
    return mapped


def snapshot_features(labels: DataFrame, snapshot: DataFrame, key: str, snap_date: str,
                      cols: Sequence[str], start=None, end=None, date_col: str = "date") -> DataFrame:
    """Snapshot left-joined on (key, date) and forward-filled per key."""
    s = snapshot
    if start is not None and end is not None:
        s = s.where(day_range(snap_date, start, end))
    s = s.select(F.col(key), F.to_date(F.col(snap_date)).alias(date_col), *cols)
    j = labels.join(s, [key, date_col], "left")
    order = [date_col] + [c for c in labels.columns if c not in (key, date_col)
                          and not c.startswith("next_7_day_labels")]
    return forward_fill(j, key, order, cols)


def interaction_features(labels: DataFrame, interactions: DataFrame, user: str, ts_col: str,
                         intent: str, values: Sequence[str], start=None, end=None,
                         days: tuple = HISTORY_DAYS, per_day: bool = False) -> DataFrame:
    """Counts of each past intent in the 60 days before each (user, date),
    inner-joined to the labels on (user, date). The date filter starts
    60 days earlier so that the first days have their history."""
    x = interactions
    if start is not None and end is not None:
        x = half_open_dates(x, ts_col, start, end, lookback_days=-days[0])
    hist = history_pivot(x, user, ts_col, intent, values, days, per_day)
    return join_features(labels, hist, [user, "date"])


def transaction_features(labels: DataFrame, txn: DataFrame, key: str, txn_date: str = "as_of_dt",
                         start=None, end=None, exclude: Sequence[str] = AUDIT_COLUMNS,
                         lag_days: int = 1) -> DataFrame:
    """Yesterday's transaction facts joined to today's labels."""
    t = txn
    if start is not None and end is not None:
        t = t.where(day_range(txn_date, start, end))
    t = t.drop(*[c for c in exclude if c in t.columns])
    return lagged_join(labels, t, key, txn_date, "date", lag_days)


@dataclass
class Prepared:
    df: DataFrame
    summary: DataFrame
    features: list
    valid: list
    numerical: list
    categorical: list
    all_missing: list = field(default_factory=list)
    all_zero: list = field(default_factory=list)
    single_cardinality: list = field(default_factory=list)
    category_map: DataFrame | None = None


def prepare_features(df: DataFrame, spec, add_periods: bool = True) -> Prepared:
    """Period columns -> drop -> summary -> valid features -> fill -> cast ->
    category codes. Only the summary (one row per column) is collected."""
    x = period_columns(df, spec.date_col) if add_periods else df
    drops = [c for c in spec.drop_cols if c in x.columns]
    x = x.drop(*drops)
    # one row per column, read several times: computed once
    summary = cut_lineage(data_summary(x))
    feats = feature_columns(x, spec)
    flags = valid_features(summary, feats).collect()
    valid = [r["var"] for r in flags if r["is_valid"]]
    order = {c: i for i, c in enumerate(x.columns)}
    valid.sort(key=order.get)
    num = [r["var"] for r in flags if r["is_valid"] and r["proposed_data_type"] == "numerical"]
    cat = [r["var"] for r in flags if r["is_valid"] and r["proposed_data_type"] == "categorical"]
    num.sort(key=order.get)
    cat.sort(key=order.get)
    x = fill_numeric(x, num, spec.numerical_fill)
    x = fill_categorical(x, cat, spec.categorical_fill)
    x = cast_decimals(x, num)
    x, cmap = index_categories(x, cat) if cat else (x, None)
    return Prepared(
        df=x, summary=summary, features=feats, valid=valid, numerical=num, categorical=cat,
        all_missing=[r["var"] for r in flags if r["all_missing"]],
        all_zero=[r["var"] for r in flags if r["all_zero"]],
        single_cardinality=[r["var"] for r in flags if r["single_cardinality"]],
        category_map=cmap)


def train_test_oos(df: DataFrame, date_col: str, cust_key: str, label: str,
                   train_start="2022-08-10", train_end="2023-03-10",
                   oos_start="2023-03-10", oos_end="2024-05-10", test_percent: int = 20, seed: int = 99,
                   artefact: str = "training"):
    """Train / test by customer inside the training window, out-of-sample
    after it; labels are encoded on the train rows only and applied to the
    test and out-of-sample rows (rows with labels unseen in training are
    dropped and reported). Returns (frame with ``split`` and
    ``<label>_idx``, label map, unknown labels)."""
    from featurelens.operators.encoding import label_encode_score, label_map
    from featurelens.operators.sampling import split_in_time
    x = split_in_time(df, date_col, cust_key, train_start, train_end, oos_start, oos_end, test_percent, seed)
    m = label_map(x.where(F.col("split") == "train"), label, artefact)
    enc, unknown = label_encode_score(x, label, m, artefact)
    return enc, m, unknown
