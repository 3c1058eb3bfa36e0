"""Column summary and data profile over the whole table.

Every column is unpivoted to (var, value) and counted per distinct value with
map-side combine, for any number of columns in one pass. Texts are counted by
a 128-bit fingerprint and their first ``HEAD`` characters: no long text moves in
a shuffle. Row, missing and zero counts, min / max of numbers, distinct counts and
the date test come from that table. The few values at both ends (samples, min and
max of texts) are picked by their heads; where those are longer than a head,
their texts are fetched by fingerprint in a second scan.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from featurelens.functions.constants import (
    NOT_APPLICABLE, REMARK_CARDINALITY, REMARK_MISSING, REMARK_ZERO,
)
from featurelens.functions import dates
from featurelens.functions.calendar import day_range
from featurelens.functions.text import remarks, value_range
from featurelens.operators.columns import (
    TEMPORAL_TYPES, nan_to_null, proposed_type,
)
from featurelens.session import write_through

SAMPLE_EACH_END = 5
HEAD = dates.LONGEST
ENDS_PART = 64


_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)
_OPEN_TEXT = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(var, s, d, l): integers travel as ``l`` (exact), floats as ``d``,
    everything else as text ``s``; no number is formatted as text until the few
    samples are picked. A NULL is one (NULL, NULL, NULL) value per column."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    vals = []
    for c in cols:
        dt = fields[c]
        x = F.col(c)
        s = F.lit(None).cast("string") if isinstance(dt, _INTEGRAL + _FRACTIONAL) else x.cast("string")
        # decimals keep their exact text (distinctness) and a double (order, zero, range)
        d = x.cast("double") if isinstance(dt, _FRACTIONAL + (T.DecimalType,)) else F.lit(None).cast("double")
        lv = x.cast("long") if isinstance(dt, _INTEGRAL) else F.lit(None).cast("long")
        vals.append(F.struct(s.alias("s"), d.alias("d"), lv.alias("l")).alias(c))
    return df.select(*vals).unpivot([], list(cols), "var", "v").select("var", "v.s", "v.d", "v.l")


def _prints() -> list:
    """Two 64-bit hashes of the text, with different seeds (NULL for none)."""
    return [F.when(F.col("s").isNotNull(), h).alias(n) for n, h in (
        ("h", F.xxhash64("s")), ("g", F.xxhash64(F.lit(0x5BD1E995), "s")))]


def _value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows per distinct value of every column: (var, h, g, head, cut, d, l,
    _c). ``cut`` tells that the text is longer than its head."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    numbers = [c for c in cols if isinstance(fields[c], _INTEGRAL + _FRACTIONAL)]
    rest = [c for c in cols if c not in numbers]
    parts = []
    if numbers:
        # numbers are counted by short keys, without texts
        parts.append(_long(df, numbers).groupBy("var", "d", "l").agg(F.count(F.lit(1)).alias("_c")).select(
            "var", F.lit(None).cast("long").alias("h"), F.lit(None).cast("long").alias("g"), F.lit(None).cast("string").alias("head"),
            F.lit(None).cast("boolean").alias("cut"), "d", "l", "_c"))
    if rest:
        keyed = _long(df, rest).select("var", *_prints(), F.left("s", F.lit(HEAD)).alias("head"),
                                       (F.char_length("s") > HEAD).alias("cut"), "d", "l")
        parts.append(keyed.groupBy("var", "h", "g", "head", "cut", "d", "l").agg(F.count(F.lit(1)).alias("_c")))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _ends(df: DataFrame, cols: Sequence[str], counts: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """Per column the ``k`` lowest and highest distinct values: two tables
    (var, array<struct<l, d, s>>) in ascending order."""
    present = F.coalesce("head", F.col("l").cast("string"), F.col("d").cast("string")).isNotNull()
    heads = counts.where(present).select("var", "h", "g", "cut", F.struct("l", "d", F.col("head").alias("s")).alias("v"))

    def ranked(x, order, limit):
        w = Window.partitionBy("var").orderBy(*order)
        return x.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit)

    up = [F.col(f"v.{c}").asc_nulls_last() for c in ("l", "d", "s")]
    down = [F.col(f"v.{c}").desc_nulls_last() for c in ("l", "d", "s")]
    # the value at which k heads are reached in a part of them: the k first of
    # all are not beyond it, so only those up to it are ranked (all of a column
    # that has fewer than k in the part)
    some = heads.where(F.pmod(F.xxhash64("h", "v.l", "v.d"), F.lit(ENDS_PART)) == 0)

    def reached(x, order, last):
        return ranked(x, order, k).groupBy("var").agg(last("v").alias("_end"), F.count(F.lit(1)).alias("_n"))

    def first(order, last, inside):
        bound = reached(some, order, last).where(F.col("_n") >= k).select("var", "_end")
        held = heads.join(F.broadcast(bound), "var", "left").where(F.col("_end").isNull() | inside(F.col("v"), F.col("_end")))
        return reached(held.drop("_end"), order, last)

    # the value at which k heads are reached from either end: one row per column
    low = first(up, F.max, lambda v, end: v <= end).select("var", F.col("_end").alias("_low"))
    high = first(down, F.min, lambda v, end: v >= end).select("var", F.col("_end").alias("_high"))
    near = (heads.join(F.broadcast(low), "var").join(F.broadcast(high), "var")
            .where((F.col("v") <= F.col("_low")) | (F.col("v") >= F.col("_high"))))
    fields = {f.name: f.dataType for f in df.schema.fields}
    texts = [c for c in cols if isinstance(fields[c], _OPEN_TEXT)]
    if texts:
        # values whose heads may be at an end, with their whole text
        cut = near.where("cut").select("var", "h", "g")
        whole = (_long(df, texts).where(F.char_length("s") > HEAD).select("var", *_prints(), "s")
                 .join(cut, ["var", "h", "g"], "left_semi").groupBy("var", "h", "g").agg(F.first("s").alias("s")))
        near = (near.where(~F.coalesce("cut", F.lit(False))).select("var", "v")
                .unionByName(whole.select("var", F.struct(F.lit(None).cast("long").alias("l"), F.lit(None).cast("double").alias("d"), "s").alias("v"))))

    def picked(order, name):
        return ranked(near.select("var", "v"), order, k).groupBy("var").agg(F.array_sort(F.collect_list("v")).alias(name))

    return picked(up, "_lo"), picked(down, "_hi")


def _meta(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column from the schema (a literal table, no scan)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    rows = [F.struct(F.lit(i).alias("col_idx"), F.lit(c).alias("var"),
                     F.lit(fields[c].simpleString()).alias("type"),
                     F.lit(proposed_type(fields[c])).alias("proposed_data_type"),
                     F.lit(isinstance(fields[c], TEMPORAL_TYPES)).alias("_temporal"),
                     F.lit(isinstance(fields[c], T.StringType)).alias("_text"))
            for i, c in enumerate(cols)]
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def column_stats(df: DataFrame, columns: Sequence[str] | None = None,
                 sample_each_end: int = SAMPLE_EACH_END) -> DataFrame:
    """Per-column facts shared by :func:`data_summary` and :func:`data_profile`.

    Row, missing and zero counts, the distinct count, numeric min / max and the
    date test (once per distinct text) come from one count per distinct value;
    see the module for the samples. ``date_format`` names the format that reads
    all values of a text column (:mod:`featurelens.functions.dates`).
    """
    cols = list(columns) if columns is not None else list(df.columns)
    df = nan_to_null(df.select(*cols))
    # the facts and both ends read it, several times
    counts = write_through(_value_counts(df, cols), "value-counts")
    present = F.col("head").isNotNull() | F.col("d").isNotNull() | F.col("l").isNotNull()
    zero = (F.col("d") == 0) | (F.col("l") == 0)
    per_var = counts.groupBy("var").agg(
        F.sum("_c").alias("rows"),
        F.coalesce(F.sum(F.when(present, F.col("_c"))), F.lit(0)).alias("non_missing_cnt"),
        F.coalesce(F.sum(F.when(zero, F.col("_c"))), F.lit(0)).alias("zero_cnt"),
        F.count(F.lit(1)).alias("num_unique"),
        F.min("d").alias("min_num"), F.max("d").alias("max_num"),
        F.min("l").alias("min_int"), F.max("l").alias("max_int"),
        F.bit_and(F.when(F.col("cut"), 0).otherwise(dates.format_mask(F.col("head")))).alias("_mask"))
    low, high = _ends(df, cols, counts, sample_each_end)
    # meta, per_var, low, high: one row per column
    out = (_meta(df, cols).join(F.broadcast(per_var), "var", "left")
                          .join(F.broadcast(low), "var", "left")
                          .join(F.broadcast(high), "var", "left"))
    both = F.array_sort(F.array_distinct(F.concat(
        F.coalesce(F.col("_lo"), F.array()), F.coalesce(F.col("_hi"), F.array()))))

    def text(x):
        return F.coalesce(x["s"], x["l"].cast("string"), x["d"].cast("string"))

    numeric = F.col("proposed_data_type") == "numerical"
    rows = F.coalesce(F.col("rows"), F.lit(0))
    return out.select(
        "col_idx", "var", "type", "proposed_data_type",
        rows.cast("long").alias("rows"),
        F.coalesce(F.col("non_missing_cnt"), F.lit(0)).cast("long").alias("non_missing_cnt"),
        F.when(numeric, F.coalesce(F.col("zero_cnt"), F.lit(0))).cast("long").alias("zero_cnt"),
        F.when(numeric, F.col("min_num")).alias("min_num"), F.when(numeric, F.col("max_num")).alias("max_num"),
        F.when(numeric, F.col("min_int")).alias("min_int"), F.when(numeric, F.col("max_int")).alias("max_int"),
        F.when(~numeric, F.get("_lo", F.lit(0))["s"]).alias("min_text"),
        F.when(~numeric, F.try_element_at("_hi", F.lit(-1))["s"]).alias("max_text"),
        F.when(F.col("_temporal"), F.lit(True)).when(F.col("_text"), F.coalesce(F.col("_mask") != 0, F.lit(True)))
         .alias("is_date_field"),
        F.when(F.col("_text"), dates.format_name(F.col("_mask"))).alias("date_format"),
        F.coalesce(F.col("num_unique"), F.lit(0)).cast("long").alias("num_unique"),
        F.transform(both, text).alias("samples"),
        F.transform(F.coalesce(F.col("_lo"), F.array()), text).alias("lowest"))


def convert_dates(df: DataFrame, columns: Sequence[str] | None = None):
    """(frame with its date texts as dates, {column: format}).

    Text columns (of ``columns``, or all) whose values one format reads become
    dates by that format; the others, and columns without a value, stay.
    One row per column is collected.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)]
    if not names:
        return df, {}
    found = {r["var"]: r["date_format"] for r in column_stats(df, names).where("date_format is not null").select("var", "date_format").collect()}
    return df.withColumns({c: F.to_date(dates.parse(F.col(c), n)) for c, n in found.items()}), found


def data_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: distinct count (NULL is a value), samples, types,
    missing and zero counts and rates, remarks."""
    st = column_stats(df, columns)
    missing = F.col("rows") - F.col("non_missing_cnt")
    numeric = F.col("proposed_data_type") == "numerical"
    zero_cnt = F.when(numeric, F.col("zero_cnt"))
    missing_rate = F.try_divide(missing, F.col("rows"))
    zero_rate = F.when(numeric, F.try_divide(F.col("zero_cnt"), F.col("rows")))
    return st.select(
        "col_idx", "var", "num_unique", "samples", "type", "proposed_data_type",
        F.col("non_missing_cnt").cast("long").alias("non_missing_cnt"),
        missing.cast("long").alias("missing_cnt"),
        missing_rate.alias("missing_rate"),
        zero_cnt.cast("long").alias("zero_cnt"),
        zero_rate.alias("zero_rate"),
        remarks((missing_rate == 1, REMARK_MISSING), (zero_rate == 1, REMARK_ZERO),
                (F.col("num_unique") == 1, REMARK_CARDINALITY)).alias("remarks"),
    )


def data_profile(df: DataFrame, columns: Sequence[str] | None = None, sample_size: int = 4) -> DataFrame:
    """Data-quality profile: records, dtype, distinct, missing, duplicated,
    up to ``sample_size`` sample values (lowest distinct) and the value range
    (numbers; text only when every value is a date), by feature name."""
    st = column_stats(df, columns)
    numeric = F.col("proposed_data_type") == "numerical"
    rng = (F.when(numeric & F.col("min_int").isNotNull(), value_range(F.col("min_int"), F.col("max_int"), "integer"))
            .when(numeric, value_range(F.col("min_num"), F.col("max_num"), "number"))
            .when(F.col("is_date_field") & F.col("min_text").isNotNull(),
                  value_range(F.col("min_text"), F.col("max_text"), "text"))
            .otherwise(F.lit(NOT_APPLICABLE)))
    return st.select(
        F.col("var").alias("feature_name"),
        F.col("rows").cast("long").alias("records_count"),
        F.col("type").alias("dtype"),
        F.col("num_unique").alias("unique_vals"),
        (F.col("rows") - F.col("non_missing_cnt")).cast("long").alias("count_missing_values"),
        (F.col("rows") - F.col("num_unique")).cast("long").alias("count_duplicated"),
        F.slice(F.col("lowest"), 1, sample_size).alias("sample_values"),
        rng.alias("range_of_features"),
    ).orderBy("feature_name")


def profile_table(df: DataFrame, partition_col: str | None = None, start=None, end=None,
                  sample_size: int | None = None, sample_seed: int = 111,
                  key_cols: Sequence[str] | None = None, with_explored_date: bool = True) -> DataFrame:
    """Profile of the (date-filtered) table plus bounds of the partition
    column over the whole table and the Spark type of each column.

    ``sample_size`` profiles a repeatable hash sample instead of every row.
    """
    part = df
    if partition_col and start is not None and end is not None:
        part = df.where(day_range(partition_col, start, end))
    if sample_size:
        from featurelens.operators.sampling import sample_n
        part = sample_n(part, sample_size, sample_seed, key_cols)
    prof = data_profile(part)
    types = F.create_map(*[x for f in df.schema.fields
                           for x in (F.lit(f.name), F.lit(f.dataType.simpleString()))])
    if partition_col:
        b = df.select(F.struct(F.min(partition_col).cast("string").alias("mn"),
                               F.max(partition_col).cast("string").alias("mx"))).scalar()
        prof = (prof.withColumn(f"min_{partition_col}", b.getField("mn"))
                    .withColumn(f"max_{partition_col}", b.getField("mx")))
    if with_explored_date:
        prof = prof.withColumn("explored_date", F.date_format(F.current_date(), "yyyy-MM-dd"))
    return prof.withColumn("spark_dtype", F.element_at(types, F.col("feature_name")))
