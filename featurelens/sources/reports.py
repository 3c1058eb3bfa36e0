"""Report sections and encoder maps as versioned sets of parquet tables.

A set is a folder with numbered manifests. A write puts its tables into new
folders first and then adds one manifest that names the current folder of
every entry; readers follow the newest manifest. So a reader sees a whole set,
the old or the new one, also during a rewrite and after a write that died.
Of two writers at once the second finds its number taken, reads the new manifest
and adds its entries to that (where a rename does not replace a file, as on
HDFS; on other file systems writers should take turns). Replaced folders stay until
:func:`vacuum`.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

_MANIFESTS, _TABLES = "_manifests", "_tables"


def _fs(spark: SparkSession, path: str):
    """The file system of a path, by Spark's own configuration."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), spark._jvm.org.apache.hadoop.fs.Path


def _numbers(spark: SparkSession, root: str) -> list[int]:
    fs, path = _fs(spark, root)
    folder = path(f"{root}/{_MANIFESTS}")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _manifest(spark: SparkSession, root: str, number: int | None = None) -> tuple[int, dict]:
    """(number, {entry: folder}) of the newest manifest; (0, {}) for none."""
    numbers = _numbers(spark, root)
    if not numbers:
        return 0, {}
    number = number or numbers[-1]
    fs, path = _fs(spark, root)
    stream = fs.open(path(f"{root}/{_MANIFESTS}/{number:012d}.json"))
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return number, json.loads(text)


def _commit(spark: SparkSession, root: str, entries: dict, clear: bool) -> None:
    """Name the new folders in one more manifest: written aside, then renamed."""
    fs, path = _fs(spark, root)
    fs.mkdirs(path(f"{root}/{_MANIFESTS}"))
    while True:
        number, old = _manifest(spark, root)
        aside = path(f"{root}/{_MANIFESTS}/.{uuid.uuid4().hex}")
        out = fs.create(aside, True)
        try:
            out.write(bytearray(json.dumps(({} if clear else old) | entries, sort_keys=True).encode()))
        finally:
            out.close()
        target = path(f"{root}/{_MANIFESTS}/{number + 1:012d}.json")
        # a rename onto a file that another writer made meanwhile fails
        if not fs.exists(target) and fs.rename(aside, target):
            return
        fs.delete(aside, False)


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete what the newest ``keep`` manifests do not name (tables of older
    sets and of writes that died); not while a write runs. Number of folders
    deleted."""
    fs, path = _fs(spark, root)
    numbers = _numbers(spark, root)
    named = {f.split("/")[0] for n in numbers[-keep:] for f in _manifest(spark, root, n)[1].values()}
    gone = 0
    if fs.exists(path(f"{root}/{_TABLES}")):
        for f in fs.listStatus(path(f"{root}/{_TABLES}")):
            if f.getPath().getName() not in named:
                gone += bool(fs.delete(f.getPath(), True))
    for n in numbers[:-keep]:
        fs.delete(path(f"{root}/{_MANIFESTS}/{n:012d}.json"), False)
    return gone


def write_report(sections: dict, base: str, report: str, overwrite: bool = False,
                 csv: bool = False) -> str:
    """Write each DataFrame of ``sections`` to the report ``<base>/<report>``.

    All sections appear at once, after the last is written; sections that are
    not written stay. ``overwrite`` leaves only the written ones.
    """
    root = f"{base.rstrip('/')}/{report}"
    if not sections:
        return root
    spark = next(iter(sections.values())).sparkSession
    version, entries = uuid.uuid4().hex, {}
    for name, df in sections.items():
        folder = f"{version}/section={name}"
        writer = df.write.option("header", True)
        (writer.csv if csv else writer.parquet)(f"{root}/{_TABLES}/{folder}")
        entries[name] = folder
    _commit(spark, root, entries, overwrite)
    return root


def report_sections(spark: SparkSession, base: str, report: str) -> dict:
    """{section: folder} of the report as it is now."""
    root = f"{base.rstrip('/')}/{report}"
    return {name: f"{root}/{_TABLES}/{folder}" for name, folder in _manifest(spark, root)[1].items()}


def read_report(spark: SparkSession, base: str, report: str, section: str) -> DataFrame:
    """A section written as parquet; KeyError if the report has none of it."""
    return spark.read.parquet(report_sections(spark, base, report)[section])


def save_artefacts(maps: DataFrame, path: str) -> str:
    """Write maps (artefact, kind, column, value, code, rest); of the saved
    maps only those of the written (artefact, kind) are replaced, all at once."""
    spark = maps.sparkSession
    version = uuid.uuid4().hex
    folder = f"{path}/{_TABLES}/{version}"
    maps.write.parquet(folder)
    kinds = spark.read.schema(maps.schema).parquet(folder).select("artefact", "kind").distinct().collect()
    _commit(spark, path, {json.dumps([r["artefact"], r["kind"]]): version for r in kinds}, False)
    return path


def load_artefacts(spark: SparkSession, path: str, artefact: str | None = None,
                   kind: str | None = None) -> DataFrame:
    """Maps back; only the files of the wanted artefact and kind are read."""
    from featurelens.operators.encoding import MAP_SCHEMA
    out = spark.createDataFrame([], MAP_SCHEMA)
    for entry, version in _manifest(spark, path)[1].items():
        a, k = json.loads(entry)
        if artefact in (None, a) and kind in (None, k):
            part = spark.read.schema(MAP_SCHEMA).parquet(f"{path}/{_TABLES}/{version}")
            out = out.unionByName(part.where((F.col("artefact") == a) & (F.col("kind") == k)))
    return out
