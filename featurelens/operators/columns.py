"""Projections, filters, fills, casts and column-role metadata."""

from __future__ import annotations

from collections import Counter
from typing import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from featurelens.functions.calendar import day_range

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
TEMPORAL_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def proposed_type(dt: T.DataType) -> str:
    """numerical for numbers (incl. decimals); categorical for everything else."""
    return "numerical" if is_numeric(dt) else "categorical"


def between_dates(df: DataFrame, col: str, start, end) -> DataFrame:
    """Days from start to end, both whole, of a date or timestamp column
    (pushed to the scan)."""
    return df.where(day_range(col, start, end))


def half_open_dates(df: DataFrame, col: str, start, end, lookback_days: int = 0) -> DataFrame:
    """``[start - lookback_days, end)``."""
    lo = F.date_sub(F.lit(start).cast("date"), lookback_days) if lookback_days else F.lit(start)
    return df.where((F.col(col) >= lo) & (F.col(col) < F.lit(end)))


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols)


def drop_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.drop(*cols)


def prefix_columns(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    """Keys first and unchanged, every other column renamed ``prefix + name``."""
    keys = [k for k in keys if k in df.columns]
    rest = [F.col(c).alias(prefix + c) for c in df.columns if c not in keys]
    return df.select(*keys, *rest)


def cast_decimals(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Decimal columns to double; NULL stays NULL."""
    want = set(cols) if cols is not None else None
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType) and (want is None or f.name in want):
            out.append(F.col(f.name).cast("double").alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float/double columns becomes NULL (pandas counts NaN as missing)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def fill_numeric(df: DataFrame, cols: Sequence[str], value=0) -> DataFrame:
    return df.na.fill(value, subset=list(cols)) if cols else df


def fill_categorical(df: DataFrame, cols: Sequence[str], value: str = "NAN") -> DataFrame:
    return df.na.fill(value, subset=list(cols)) if cols else df


def feature_columns(df: DataFrame, spec) -> list[str]:
    """Columns that are not keys, date keys or the label."""
    skip = spec.non_features()
    return [c for c in df.columns if c not in skip]


def column_roles(df: DataFrame, spec=None) -> DataFrame:
    """One row per column: position, name, Spark type, proposed type, role."""
    spark = df.sparkSession
    rows = []
    skip_p = set(spec.pkeys) if spec else set()
    skip_d = set(spec.dkeys) if spec else set()
    label = spec.label if spec else None
    for i, f in enumerate(df.schema.fields):
        role = ("label" if f.name == label else "primary_key" if f.name in skip_p
                else "date_key" if f.name in skip_d else "feature")
        rows.append((i, f.name, f.dataType.simpleString(), proposed_type(f.dataType), role))
    return spark.createDataFrame(
        rows, "col_idx int, var string, spark_dtype string, proposed_data_type string, role string")


def features_by_proposed_type(summary: DataFrame, kind: str) -> DataFrame:
    """Names (``var``) of the summary rows with proposed_data_type == kind."""
    return summary.where(F.col("proposed_data_type") == kind).select("var")


def valid_features(summary: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Summary rows with the three drop reasons as flags and ``is_valid``."""
    s = summary
    if features is not None:
        s = s.where(F.col("var").isin(list(features)))
    all_missing = F.coalesce(F.col("missing_rate") == 1, F.lit(False))
    all_zero = F.coalesce(F.col("zero_rate") == 1, F.lit(False))
    single = F.coalesce(F.col("num_unique") == 1, F.lit(False))
    return s.select(
        "var", "proposed_data_type",
        all_missing.alias("all_missing"), all_zero.alias("all_zero"),
        single.alias("single_cardinality"),
        (~(all_missing | all_zero | single)).alias("is_valid"))


def one_vs_rest_label(df: DataFrame, label_col: str, label, out: str = "pseudo_label") -> DataFrame:
    return df.withColumn(out, F.col(label_col).eqNullSafe(F.lit(label)).cast("int"))


def duplicate_columns(df: DataFrame) -> list[str]:
    """Column names that occur more than once (metadata only)."""
    return [n for n, k in Counter(df.columns).items() if k > 1]


def stringify_temporal(df: DataFrame) -> DataFrame:
    """Date and timestamp columns cast to text, chosen by type."""
    return df.select(*[
        F.col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, TEMPORAL_TYPES)
        else F.col(f.name) for f in df.schema.fields])
