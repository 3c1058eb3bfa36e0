"""Tables in and out (parquet)."""

from __future__ import annotations

import posixpath
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession

from featurelens.functions.constants import SAMPLE_ROWS, SAMPLE_SEED


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table; ``columns`` prunes the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_table(df: DataFrame, path: str, mode: str = "errorifexists",
                partition_by: Sequence[str] | None = None) -> str:
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def sample_path(path: str) -> str:
    """``<dir>/<stem>_sample`` next to the source (never the source itself)."""
    p = path.rstrip("/")
    d, base = posixpath.split(p)
    stem = base[:-len(".parquet")] if base.endswith(".parquet") else base
    return posixpath.join(d, f"{stem}_sample")


def sample_table_to_path(spark: SparkSession, path: str, n: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED,
                         key_cols: Sequence[str] | None = None, out_path: str | None = None,
                         mode: str = "overwrite"):
    """Read a table, take exactly min(n, rows) repeatable rows, write them.
    Returns (sample DataFrame read back, output path)."""
    from featurelens.operators.sampling import sample_n
    out = out_path or sample_path(path)
    if out.rstrip("/") == path.rstrip("/"):
        raise ValueError("sample output path equals the source path")
    write_table(sample_n(read_table(spark, path), n, seed, key_cols), out, mode)
    return spark.read.parquet(out), out
