"""Mixing sources to target weights by Pareto order sampling.

Targets: sources share the words of the mix by weight; a source's target
stops at ``cap`` times its size and the excess is shared again by weight among
the others, which has the closed form target = min(cap * size, level * weight).

Documents: a document's expected copies are its source's target over its
source's size, times its own relative weight if it has one. Its whole copies
are certain; the fraction p is its inclusion probability. Documents are ranked
by Pareto's ratio of random odds to inclusion odds, (u / (1 - u)) / (p / (1 - p)),
and the sample of a source is the start of that ranking whose words come
nearest to what the fractions leave to take.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from featurelens.llm.tables import stage
from featurelens.operators.ranking import running_total

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(totals: DataFrame, weights=(5, 2, 1), cap: int = 3) -> DataFrame:
    """(source, source_size, rank, weight, target) from (source, source_size),
    one row per source. Sources in code point order, null last, take the
    weights in turn."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    t = totals.withColumn("rank", F.row_number().over(by_name) - 1)
    pick = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = t.withColumn("weight", pick).withColumn("most", F.col("source_size") * cap)
    order = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    t = (t.withColumn("all_words", F.sum("source_size").over(everything))
         .withColumn("full", F.coalesce(F.sum("most").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
         .withColumn("left", F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
         .withColumn("try_level", (F.col("all_words") - F.col("full")).cast("double") / F.col("left")))
    # the first source in order of fill that is not full fixes the level
    fits = F.col("try_level") * F.col("weight") <= F.col("most")
    t = t.withColumn("level", F.max(F.when(fits, F.col("try_level"))).over(everything))
    return t.select("source", "source_size", "rank", "weight",
                    F.least(F.col("most").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def _uniform(col, seed: int):
    """A number inside (0, 1) from the md5 of id and seed."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(col.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def _copies(rows: DataFrame, cap: int) -> DataFrame:
    """Expected copies per document for unequal document weights: the factor
    of a source rises until its capped documents' excess is taken by the rest."""
    full = F.col("factor") * F.col("doc_weight") > cap
    factors = rows.groupBy("rank").agg(
        F.coalesce(F.try_divide(F.first("target"), F.sum(F.col("doc_weight") * F.col("size"))), F.lit(0.0)).alias("factor"))
    while True:
        seen = rows.join(factors, "rank")
        nxt = stage(seen.groupBy("rank", "factor", "target").agg(
            F.sum(F.when(full, F.col("size") * cap).otherwise(0)).alias("taken"),
            F.sum(F.when(full, 0.0).otherwise(F.col("doc_weight") * F.col("size"))).alias("open"))
            .select("rank", "factor", F.when(F.col("open") > 0, (F.col("target") - F.col("taken")) / F.col("open"))
                    .otherwise(F.col("factor")).alias("better")), "mix-factors")
        if not nxt.where("better > factor * (1 + 1e-12)").head(1):
            return rows.join(nxt.select("rank", "factor"), "rank").withColumn(
                "copies", F.least(F.lit(float(cap)), F.col("factor") * F.col("doc_weight"))).drop("factor")
        factors = nxt.select("rank", F.col("better").alias("factor"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights=(5, 2, 1), cap: int = 3, seed: int = 17, doc_weight: str | None = None) -> DataFrame:
    """One row per document: (id_col, size, source_size, target, taken).

    ``size`` is the number of words, ``taken`` the words the mix takes of it
    (whole copies, at most ``cap``). ``doc_weight`` names an optional column of
    positive relative weights inside a source. Null and empty texts have size 0 and give 0 words; a null
    source is a source of its own, the last; a repeated row is another
    document; an empty table gives no rows. The draw depends on the id and the
    seed only.
    """
    w = F.col(doc_weight).cast("double") if doc_weight else F.lit(1.0)
    rows = stage(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                             F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                             w.alias("doc_weight")), "mix-sizes")
    targets = stage(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap), "mix-targets")
    rows = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop("source")
    if doc_weight:
        rows = _copies(rows, cap)
    else:
        rows = rows.withColumn("copies", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    rows = (rows.withColumn("whole", F.floor("copies")).withColumn("p", F.col("copies") - F.col("whole"))
            .withColumn("u", _uniform(F.col("id"), seed))
            .withColumn("score", F.when(F.col("p") > 0, F.col("u") / (1 - F.col("u")) / (F.col("p") / (1 - F.col("p"))))))
    open_ = rows.where("p > 0 and size > 0").select("rank", "id", "size", "score", "whole", "target", "source_size")
    rest = rows.where("not (p > 0 and size > 0)")
    need = rows.groupBy("rank").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("need"))
    ranked = running_total(open_, ["score", "id", "size"], ["rank"], "size", "upto").join(need, "rank")
    before = F.col("upto") - F.col("size")
    drawn = (before < F.col("need")) & (F.col("upto") - F.col("need") <= F.col("need") - before)
    out = [F.col("id").alias(id_col), "size", "source_size", "target"]
    taken = ranked.select(*out, ((F.col("whole") + drawn.cast("long")) * F.col("size")).alias("taken"))
    return taken.unionByName(rest.select(*out, (F.col("whole") * F.col("size")).alias("taken")))
