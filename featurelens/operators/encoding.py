"""Label and category encoders whose maps are DataFrames.

Map schema: (artefact, kind, column, value, code, rest). ``rest`` marks the row of
the code for NULL and unseen values, whatever texts the data hold. Codes are
positions in an explicit order, computed by :func:`ordered_index` over range
partitions, so a column with many distinct values never sorts in one task.

Maps are applied to any number of columns without a join per column. The columns
whose maps are small (measured, up to ``DICT_BYTES`` together) look their codes
up in constant arrays of hash buckets. The other columns are melted to (row, column, value), joined with their map at
once and brought back by row.
"""

from __future__ import annotations

import json
from typing import Sequence

from pyspark.sql import DataFrame, functions as F

from featurelens.functions.constants import LEAST_PERC
from featurelens.operators.ranking import ordered_index
from featurelens.session import cut_lineage

MAP_SCHEMA = "artefact string, kind string, column string, value string, code long, rest boolean"
DICT_BYTES = 4 << 20


def _map_rows(df: DataFrame, artefact: str, kind: str) -> DataFrame:
    return df.select(F.lit(artefact).alias("artefact"), F.lit(kind).alias("kind"),
                     F.col("column"), F.col("value").cast("string").alias("value"),
                     F.col("code").cast("long").alias("code"),
                     (F.col("rest") if "rest" in df.columns else F.lit(False)).alias("rest"))


def label_map(df: DataFrame, label: str, artefact: str = "training") -> DataFrame:
    """label -> 0..k-1 in label order (NULL labels left out)."""
    d = df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("value")).distinct()
    idx = ordered_index(d, [F.col("value")], out="code")
    return _map_rows(idx.withColumn("column", F.lit(label)), artefact, "label")


def apply_label_map(df: DataFrame, label: str, maps: DataFrame, artefact: str = "training",
                    out: str | None = None, how: str = "left") -> DataFrame:
    m = (maps.where((F.col("artefact") == artefact) & (F.col("kind") == "label") & (F.col("column") == label))
             .select(F.col("value").alias("_fl_v"), F.col("code").alias(out or f"{label}_idx")))
    return df.join(m, F.col(label).cast("string") == F.col("_fl_v"), how).drop("_fl_v")


def label_encode(df: DataFrame, label: str, artefact: str = "training", out: str | None = None):
    """(frame with ``<label>_idx``, map). The text label is kept."""
    m = label_map(df, label, artefact)
    return apply_label_map(df, label, m, artefact, out), m


def label_encode_score(df: DataFrame, label: str, maps: DataFrame, artefact: str = "training",
                       out: str | None = None):
    """Apply a saved label map; rows with unknown labels are dropped and the
    unknown labels returned: (encoded frame, unknown labels)."""
    enc = apply_label_map(df, label, maps, artefact, out, how="inner")
    known = maps.where((F.col("artefact") == artefact) & (F.col("kind") == "label")
                       & (F.col("column") == label)).select(F.col("value").alias("label"))
    unknown = (df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"))
                 .distinct().join(known, "label", "left_anti"))
    return enc, unknown


def _long_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    vals = [F.col(c).cast("string").alias(c) for c in cols]
    return df.select(*vals).unpivot([], list(cols), "column", "value")


def index_categories_map(df: DataFrame, cols: Sequence[str], artefact: str = "training") -> DataFrame:
    """Per column: sorted distinct values -> 0..n-1."""
    d = _long_values(df, cols).where(F.col("value").isNotNull()).distinct()
    idx = ordered_index(d, [F.col("value")], ["column"], out="code")
    # the map is read several times: written once
    return cut_lineage(_map_rows(idx, artefact, "index"))


def encode_categories_map(df: DataFrame, cols: Sequence[str], artefact: str = "training") -> DataFrame:
    """Per column: codes by frequency desc (ties: value asc). The least
    frequent value is left out and its code n-1 becomes the rest code (value
    ``least_perc``, flag ``rest``)."""
    counts = (_long_values(df, cols).where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("_fl_n")))
    idx = ordered_index(counts, [F.col("_fl_n").desc(), F.col("value").asc()], ["column"], out="code")
    # sizes from the (checkpointed) ranking, not from the raw table again;
    # one row per encoded column
    sizes = idx.groupBy("column").agg((F.max("code") + 1).alias("_fl_k"))
    idx = idx.join(F.broadcast(sizes), "column")
    kept = idx.where(F.col("code") < F.col("_fl_k") - 1).select("column", "value", "code")
    least = sizes.select("column", F.lit(LEAST_PERC).alias("value"), (F.col("_fl_k") - 1).alias("code"), F.lit(True).alias("rest"))
    # the map is read several times: written once
    return cut_lineage(_map_rows(kept.withColumn("rest", F.lit(False)).unionByName(least), artefact, "category"))


def _looked_up(codes: DataFrame, entries: dict[str, int]) -> dict:
    """Per column the expression of its code by a constant dictionary: an
    array of as many hash buckets as the column has values, so a value meets
    few entries. The entries of ``codes`` are collected (measured before)."""
    size = F.create_map(*[F.lit(x) for c, n in entries.items() for x in (c, max(n, 1))])
    placed = codes.select("column", "value", "code", F.pmod(F.xxhash64("value"), size[F.col("column")]).alias("b")).collect()
    buckets = {c: [[] for _ in range(max(n, 1))] for c, n in entries.items()}
    for r in placed:
        buckets[r["column"]][r["b"]].append({"v": r["value"], "c": r["code"]})

    def code(c, dictionary):
        text = F.col(c).cast("string")
        # a constant: parsed once, when the plan is made
        constant = F.from_json(F.lit(json.dumps(dictionary)), "array<array<struct<v:string,c:bigint>>>")
        at = F.pmod(F.xxhash64(text), F.lit(len(dictionary))).cast("int")
        return F.get(F.filter(F.get(constant, at), lambda e: e["v"] == text), F.lit(0))["c"]

    return {c: code(c, dictionary) for c, dictionary in buckets.items()}


def _melted(df: DataFrame, cols: Sequence[str], codes: DataFrame) -> DataFrame:
    """``df`` with the code of each of ``cols`` as ``_fl_code_<i>``: one join
    and one grouping for all columns. The rows are numbered in a checkpoint."""
    rows = cut_lineage(df.withColumn("_fl_row", F.monotonically_increasing_id()))
    long = (rows.select("_fl_row", *[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot(["_fl_row"], list(cols), "column", "value").where("value is not null"))
    got = (long.join(codes, ["column", "value"]).groupBy("_fl_row")
           .agg(*[F.max(F.when(F.col("column") == c, F.col("code"))).alias(f"_fl_code_{i}") for i, c in enumerate(cols)]))
    return rows.join(got, "_fl_row", "left").drop("_fl_row")


def map_columns(df: DataFrame, cols: Sequence[str], codes: DataFrame, dict_bytes: int = DICT_BYTES) -> tuple[DataFrame, dict]:
    """(frame, {column: expression of its code}) for the map ``codes``
    (column, value, code); absent values have NULL. One row per column is
    collected: how large its part of the map is."""
    cols = list(dict.fromkeys(cols))
    codes = codes.select("column", "value", "code").where(F.col("column").isin(cols))
    sizes = sorted((r["b"], r["column"], r["n"]) for r in codes.groupBy("column").agg(
        F.sum(F.octet_length("value") + F.octet_length("column") + 48).alias("b"), F.count("*").alias("n")).collect())
    small, used = {}, 0
    for b, c, n in sizes:
        if used + b > dict_bytes:
            break
        small[c] = n
        used += b
    known = {c for _, c, _ in sizes}
    large = [c for c in cols if c in known and c not in small]
    out = {c: F.lit(None).cast("long") for c in cols}
    if large:
        df = _melted(df, large, codes.where(F.col("column").isin(large)))
        out |= {c: F.col(f"_fl_code_{i}") for i, c in enumerate(large)}
    if small:
        out |= _looked_up(codes.where(F.col("column").isin(list(small))), small)
    return df, out


def apply_category_map(df: DataFrame, cols: Sequence[str], maps: DataFrame, artefact: str = "training",
                       kind: str = "category", suffix: str = "", dict_bytes: int = DICT_BYTES) -> DataFrame:
    """Replace each column by its code; NULL and unseen values get the rest
    code (kind ``category``) or NULL (kind ``index``)."""
    m = maps.where((F.col("artefact") == artefact) & (F.col("kind") == kind))
    least = {}
    if kind == "category":
        # one code per column: collected, O(columns)
        least = {r["column"]: r["code"] for r in m.where("rest").select("column", "code").collect()}
    names = df.columns
    x, codes = map_columns(df, cols, m.where("not rest"), dict_bytes)
    made = {c + suffix: F.coalesce(codes[c], F.lit(least.get(c))).cast("long") for c in cols}
    return x.select(*[made.pop(n).alias(n) if n in made else F.col(n) for n in names], *[e.alias(n) for n, e in made.items()])


def index_categories(df: DataFrame, cols: Sequence[str], artefact: str = "training"):
    m = index_categories_map(df, cols, artefact)
    return apply_category_map(df, cols, m, artefact, "index"), m


def encode_categories_train(df: DataFrame, cols: Sequence[str], artefact: str = "training"):
    """(encoded frame, map) fitted on ``df``."""
    m = encode_categories_map(df, cols, artefact)
    return apply_category_map(df, cols, m, artefact, "category"), m


def encode_categories_score(df: DataFrame, cols: Sequence[str], maps: DataFrame,
                            artefact: str = "training") -> DataFrame:
    """Apply a map of :func:`encode_categories_map`."""
    return apply_category_map(df, cols, maps, artefact, "category")


def label_encode_train(df: DataFrame, label: str, path: str, artefact: str = "training", out: str | None = None) -> DataFrame:
    """Encode the label and save its map to the artefact table at ``path``."""
    from featurelens.sources.reports import save_artefacts
    enc, m = label_encode(df, label, artefact, out)
    save_artefacts(m, path)
    return enc


def encode_categories_fit(df: DataFrame, cols: Sequence[str], path: str, artefact: str = "training") -> DataFrame:
    """Encode the columns and save their map to the artefact table at ``path``."""
    from featurelens.sources.reports import save_artefacts
    enc, m = encode_categories_train(df, cols, artefact)
    save_artefacts(m, path)
    return enc


# retraining: the same functions under another artefact name
def label_encode_retrain(df: DataFrame, label: str, path: str, out: str | None = None) -> DataFrame:
    return label_encode_train(df, label, path, "retraining", out)


def encode_categories_retrain(df: DataFrame, cols: Sequence[str], path: str) -> DataFrame:
    return encode_categories_fit(df, cols, path, "retraining")


def encode_categories_retrain_score(df: DataFrame, cols: Sequence[str], path: str) -> DataFrame:
    """Apply the map that :func:`encode_categories_retrain` saved."""
    from featurelens.sources.reports import load_artefacts
    return encode_categories_score(df, cols, load_artefacts(df.sparkSession, path, "retraining"), "retraining")
