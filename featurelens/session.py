"""Session settings and the shared scratch / checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "featurelens",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster leave ``master`` as None and let spark-submit decide.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster names it; we only pick one ourselves in local mode (tests,
    bench), where a local folder is the shared folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote (Connect) sessions have no SparkContext
        sc = None
    if not d:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; set it to a shared folder "
                "(HDFS/object store) that all executors can reach")
        d = tempfile.mkdtemp(prefix="featurelens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/featurelens-scratch/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint to the shared folder (survives executor loss).

    The write is the only computation of the upstream. Files of checkpoints
    that are no longer referenced go with ``spark.cleaner.referenceTracking.
    cleanCheckpoints``, which :func:`get_session` sets.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def write_through(df, name: str):
    """``df`` written once to the shared folder as parquet and read back, for
    tables that are read many times, each time in part of their columns."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["get_session", "checkpoint_dir", "scratch_dir", "cut_lineage", "write_through", "DEFAULT_CONF"]

