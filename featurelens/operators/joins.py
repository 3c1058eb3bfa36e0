"""Joins of the feature pipeline.

No join hint is given for data-derived tables: with AQE on, Spark measures
the real size of each side after its shuffle and switches to a broadcast
join below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (a checked
size), keeping the sort-merge join above it. Explicit ``broadcast`` is used
only for tables whose size is bounded by construction (one row per column,
per label or per period).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, functions as F


def join_mapping(df: DataFrame, mapping: DataFrame, left_on: str, right_on: str,
                 mapped_key: str | None = None, how: str = "inner") -> DataFrame:
    """Equi-join on differently named keys; rows whose mapped key is NULL dropped."""
    j = df.join(mapping, df[left_on] == mapping[right_on], how)
    return j.where(F.col(mapped_key).isNotNull()) if mapped_key else j


def join_features(labels: DataFrame, feats: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    return labels.join(feats, list(on), how)


def lagged_join(labels: DataFrame, feats: DataFrame, key: str, feat_date: str,
                date_col: str = "date", lag_days: int = 1, how: str = "inner") -> DataFrame:
    """Feature rows of day d are joined to label rows of day d + lag_days."""
    shifted = feats.withColumn(date_col, F.date_add(F.to_date(F.col(feat_date)), lag_days))
    if feat_date != date_col:
        shifted = shifted.drop(feat_date)
    return labels.join(shifted, [key, date_col], how)


def customer_membership_join(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key is in ``members`` (semi join, no duplication)."""
    return df.join(members.select(key), key, "left_semi")


def lookup_map(df: DataFrame, col: str, mapping: DataFrame, value_col: str = "value",
               code_col: str = "code", out: str | None = None) -> DataFrame:
    """value -> code by a map table; NULL when absent."""
    m = mapping.select(F.col(value_col).alias("_fl_v"), F.col(code_col).alias("_fl_code"))
    j = df.join(m, df[col] == m["_fl_v"], "left").drop("_fl_v")
    return j.withColumnRenamed("_fl_code", out or f"{col}_code")


def lookup_maps(df: DataFrame, cols: Sequence[str], mapping: DataFrame, suffix: str = "_code") -> DataFrame:
    """:func:`lookup_map` for any number of columns by one map table (column,
    value, code), without a join per column: codes in ``<column><suffix>``."""
    from featurelens.operators.encoding import map_columns
    names = df.columns
    x, codes = map_columns(df, cols, mapping)
    return x.select(*names, *[codes[c].alias(c + suffix) for c in cols])


def labels_not_in(a: DataFrame, b: DataFrame, col: str, b_col: str | None = None) -> DataFrame:
    """Distinct values of a.col that do not occur in b.b_col."""
    bc = b_col or col
    left = a.select(F.col(col).alias("label")).where(F.col("label").isNotNull()).distinct()
    right = b.select(F.col(bc).alias("label")).distinct()
    return left.join(right, "label", "left_anti")
