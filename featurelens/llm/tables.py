"""Intermediate tables in the shared folder, and connected components."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from featurelens.session import checkpoint_dir, scratch_dir

_ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> None:
    """Lets Python workers import the package from where the driver has it
    (a cluster without that folder gets the package by --py-files)."""
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)


#: Spark's setting that removes a query's shuffle files when it ends.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage
    is cut, and a lost executor takes nothing with it. ``free``: the shuffle
    files of the write go when it ends."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true" if free else before)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes the files of tables of :func:`stage` that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage_by_key(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Like :func:`stage`, as a table bucketed by ``key``: later groupings by
    the key read it where it lies, without a shuffle."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    table = "llm_" + "".join(c if c.isalnum() else "_" for c in path.rsplit("/", 1)[-1])
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def _cut(df: DataFrame) -> DataFrame:
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def connected_components(edges: DataFrame) -> DataFrame:
    """Distributed union-find: (id, component) of every id in ``edges``
    (columns u, v of long); ``component`` is the smallest id reachable.

    Alternates large-star and small-star steps until the edges are stars.
    Every step is a minimum per node (combined before the shuffle) and a join
    that AQE may split, so the hub of a star does not load one task; each
    round is a reliable checkpoint. Null ends and loops are ignored. No edges
    give no rows.
    """
    e = _cut(edges.where("u is not null and v is not null and u <> v")
             .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        e = _cut(small)
        # stars: no id has two heads, and no head has one
        ends = e.select(F.col("u").alias("id"), F.lit(1).alias("under"), F.lit(0).alias("over")).unionAll(
            e.select("v", F.lit(0), F.lit(1)))
        if not ends.groupBy("id").agg(F.sum("under").alias("under"), F.max("over").alias("over")).where("under + over > 1").head(1):
            break
    return (e.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .unionAll(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
