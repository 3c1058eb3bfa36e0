"""Personal data by bootstrapped contextual extraction, DataFrame only.

Seeds are the identifiers that plain rules find (email, ip, card, phone).
Their neighbour words induce lexical patterns of three sorts: the word before,
the word after, and both. Candidates are runs of words that hold a digit, an @
or a mark between letters, without what the rules found; a candidate may count
for a kind if its makeup (letters against digits, and their number) is like the
seeds', whatever its marks, spaces and order. Patterns and instances form a
graph that Spark scores in rounds: a pattern's confidence is the share of its
kind among the distinct instances in its context, where an open candidate of
the kind's makeup counts half against it; a candidate's confidence is that of
its best pattern. Candidates accepted in a round induce patterns in the next
one. What stands in a pattern of high confidence is added to the seeds' spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from featurelens.llm.tables import stage

# The rules of the base kinds, in the order of the report. Runs
# are possessive and start at their first character, or at the end of the last
# match (\G): the same matches, in time linear in the text.
KINDS = ("email", "ip", "card", "phone")
RULES = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_MARK, _LETTER = r"._(){}\[\]", r"[A-Za-z\x{C0}-\x{10FFFF}]"
WORD = rf"(?<!\S)(?:[^\s0-9@]*+[0-9@]|[^\s{_MARK}]++[{_MARK}]++{_LETTER})\S*+"
HOLDS_WORD = rf"[0-9@]|[{_MARK}]{_LETTER}"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_STEP = 256
_NEAR = 64


def _holds(kind: str) -> Column:
    """A cheap test that a text can hold the kind at all."""
    text = F.col("text")
    return {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike("[0-9]"))


def _luhn(digits: Column) -> Column:
    back = F.split(F.reverse(digits), "")
    total = F.aggregate(F.transform(F.filter(back, lambda c: c != ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2))), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)


def _found(kind: str, rule: str) -> Column:
    """array<struct<start,end,token,before,after,joins>> of a rule's matches,
    in order: offsets in code points from the lengths of the matches and of the
    pieces between them, summed in steps of ``_STEP``. ``joins`` tells that one
    space parts the match from the one before."""
    text = F.col("text")
    hits, pieces = F.regexp_extract_all(text, F.lit(rule), F.lit(0)), F.split(text, rule, -1)
    # matches and pieces are bound once: lambdas look them up by position
    bound = F.array(F.struct(hits.alias("h"), pieces.alias("p")))
    sized = F.transform(bound, lambda q: F.transform(q["h"], lambda m, i: F.struct(
        m.alias("m"), F.char_length(m).cast("long").alias("n"),
        (F.char_length(F.get(q["p"], i)) + F.char_length(m)).cast("long").alias("all"),
        F.right(F.get(q["p"], i), F.lit(_NEAR)).alias("before"),
        F.left(F.get(q["p"], i + 1), F.lit(_NEAR)).alias("after"))))
    packed = F.transform(sized, lambda s: F.struct(s.alias("a"), F.transform(s, lambda x: x["all"]).alias("len")))

    def total(arr):
        return F.aggregate(arr, F.lit(0).cast("long"), lambda a, x: a + x)

    def places(p):
        steps = F.transform(F.sequence(F.lit(0), F.floor(F.size(p["len"]) / _STEP).cast("int")),
                            lambda c: total(F.slice(p["len"], c * _STEP + 1, F.lit(_STEP))))
        q = F.struct(p["a"].alias("a"), p["len"].alias("len"), steps.alias("steps"))
        heads = F.transform(F.array(q), lambda w: F.struct(
            w["a"].alias("a"), w["len"].alias("len"),
            F.transform(w["steps"], lambda _, c: total(F.slice(w["steps"], F.lit(1), c))).alias("heads")))
        return F.flatten(F.transform(heads, lambda w: F.transform(w["a"], lambda x, i: F.struct(
            (F.get(w["heads"], F.floor(i / _STEP).cast("int")) + total(F.slice(
                w["len"], F.floor(i / _STEP).cast("int") * _STEP + 1, i % _STEP + 1)) - x["n"]).alias("start"),
            x["n"].alias("n"), x["m"].alias("token"), x["before"].alias("before"), x["after"].alias("after")))))

    spans = F.flatten(F.transform(packed, places))
    spans = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (s["start"] + s["n"]).alias("end"), s["token"].alias("token"),
        F.lower(F.regexp_extract(s["before"], r"(\S+)\s+[^\s\p{L}\p{N}]*$", 1)).alias("before"),
        F.lower(F.regexp_extract(s["after"], r"^[^\s\p{L}\p{N}]*+\s+(\S+)", 1)).alias("after"),
        (s["before"] == " ").alias("joins")))
    if kind in RULES:
        spans = F.filter(spans, lambda s: _valid(kind, s["token"]))
    return spans


_EMPTY = "array<struct<start:bigint,end:bigint,token:string,before:string,after:string,joins:boolean>>"


def _size(token: Column) -> Column:
    return F.char_length(F.regexp_replace(token, r"[^\p{L}0-9]", ""))


def _makeup(token: Column) -> Column:
    """9 for digits only, a for as many letters as digits or more, m between."""
    digits = F.char_length(F.regexp_replace(token, "[^0-9]", ""))
    return F.when(digits == _size(token), "9").when(2 * digits <= _size(token), "a").otherwise("m")


def _rows(found: DataFrame, column: str) -> DataFrame:
    return found.select("dk", F.explode(column).alias("s")).select("dk", "s.*").distinct()


def _runs(words: DataFrame) -> DataFrame:
    """Words parted by one space are one candidate, without quotes before it
    and marks after it: (dk, start, end, token, before, after)."""
    one = Window.partitionBy("dk").orderBy("start")
    first = F.coalesce(~(F.col("joins") & (F.lag("end").over(one) == F.col("start") - 1)), F.lit(True))
    runs = (words.withColumn("run", F.sum(first.cast("int")).over(one)).groupBy("dk", "run")
            .agg(F.array_sort(F.collect_list(F.struct("start", "end", "token", "before", "after"))).alias("w")))
    whole = F.array_join(F.transform("w", lambda x: x["token"]), " ")
    left = F.regexp_replace("whole", r"^[\"'<\[{]+", "")
    runs = (runs.withColumn("whole", whole).withColumn("left", left)
            .withColumn("start", F.col("w")[0]["start"] + F.char_length("whole") - F.char_length("left"))
            .withColumn("token", F.regexp_replace("left", r"[^\p{L}\p{N})\]]+$", ""))
            .withColumn("token", F.when(F.col("token").contains("("), F.col("token")).otherwise(F.regexp_replace("token", r"[^\p{L}\p{N}]+$", "")))
            .withColumn("end", F.col("start") + F.char_length("token")))
    return runs.where("token <> ''").select("dk", "start", "end", "token", F.col("w")[0]["before"].alias("before"),
                                            F.element_at("w", -1)["after"].alias("after"))


def _contexts() -> Column:
    """The word before, the word after and both, as far as there are words."""
    def side(name, there, *words):
        return F.when(there, F.concat_ws(" ", F.lit(name), *words))
    before, after = F.col("before") != "", F.col("after") != ""
    return F.filter(F.array(side("l", before, "before"), side("r", after, "after"), side("b", before & after, "before", "after")),
                    lambda c: c.isNotNull())


def discover(found: DataFrame, rounds: int, min_confidence: float, min_seeds: int, smooth: float) -> DataFrame:
    """(dk, kind, start, end, token) that patterns of high confidence find."""
    seeds = None
    for k in KINDS:
        one = _rows(found, k).withColumn("kind", F.lit(k))
        seeds = one if seeds is None else seeds.unionByName(one)
    words = _rows(found, "words").join(
        seeds.select(F.col("dk").alias("sdk"), F.col("start").alias("s0"), F.col("end").alias("s1")),
        F.expr("dk = sdk and start < s1 and s0 < end"), "left_anti")
    graph = stage(seeds.drop("joins").unionByName(_runs(words).withColumn("kind", F.lit(None).cast("string")))
                  .withColumn("contexts", _contexts()).drop("before", "after"), "pii-graph")
    # one row for an instance: a seed's kind, and the kinds whose seeds are like it
    known = graph.groupBy("token").agg(F.min("kind").alias("own"))
    like = (known.where("own is not null").groupBy("own", _makeup(F.col("token")).alias("makeup"))
            .agg((F.min(_size(F.col("token"))) / 2).alias("low"), (F.max(_size(F.col("token"))) * 2).alias("high")))
    fits = (known.where("own is null").withColumn("makeup", _makeup(F.col("token")))
            .join(F.broadcast(like.withColumnRenamed("own", "fit")), "makeup")
            .where(_size(F.col("token")).between(F.col("low"), F.col("high"))).groupBy("token").agg(F.collect_set("fit").alias("fits")))
    edges = stage(graph.select("token", F.explode("contexts").alias("context")).distinct()
                  .join(known, "token").join(fits, "token", "left")
                  .withColumn("fits", F.coalesce("fits", F.array().cast("array<string>"))), "pii-edges")
    score, strong = None, None
    for _ in range(rounds):
        linked = edges.withColumn("kind", F.col("own")).withColumn("conf", F.lit(1.0)) if score is None else (
            edges.join(score, "token", "left").withColumn("kind", F.coalesce("own", "best.kind"))
            .withColumn("conf", F.when(F.col("own").isNotNull(), 1.0).otherwise(F.col("best.conf"))))
        sums = linked.groupBy("context").agg(F.count("*").alias("n"), *[x for k in KINDS for x in (
            F.sum(F.when(F.col("kind") == k, F.col("conf")).otherwise(0.0)).alias(f"sum_{k}"),
            F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{k}"),
            F.count(F.when(F.col("kind").isNull() & F.array_contains("fits", k), 1)).alias(f"open_{k}"))])
        each = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"n_{k}").alias("n"), (
            F.col(f"sum_{k}") / (F.col("n") - F.col(f"open_{k}") / 2 + smooth)).alias("conf")) for k in KINDS])
        strong = stage(sums.select("context", F.explode(each).alias("p")).select("context", "p.*")
                       .where((F.col("n") >= min_seeds) & (F.col("conf") >= min_confidence)).select("context", "kind", "conf"), "pii-patterns")
        score = stage(edges.where("own is null").join(strong, "context").where(F.array_contains("fits", F.col("kind")))
                      .groupBy("token").agg(F.max(F.struct("conf", "kind")).alias("best")), "pii-scores")
    if strong is None:
        return graph.where("false").select("dk", "kind", "start", "end", "token")
    open_ = graph.where("kind is null").drop("kind").join(fits, "token").withColumn("context", F.explode("contexts"))
    return (open_.join(strong, "context").where(F.array_contains("fits", F.col("kind")))
            .groupBy("dk", "start", "end", "token").agg(F.max(F.struct("conf", "kind")).alias("best"))
            .select("dk", F.col("best.kind").alias("kind"), "start", "end", "token"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 3,
             min_confidence: float = 0.75, min_seeds: int = 3, smooth: float = 0.5) -> DataFrame:
    """One row per document: (id_col, email, ip, card, phone, found).

    The four kinds are arrays of structs (start, end, token, ...) of the base
    rules, by start; ``found`` holds structs (kind, start, end, token) of the
    patterns' finds. Offsets are code points, the end exclusive. Null texts are
    empty; repeated rows stay and get the same spans; an empty table gives no
    rows. Texts are processed whole and never shuffled.
    """
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    cols = [F.when(_holds(k), _found(k, RULES[k])).otherwise(F.array().cast(_EMPTY)).alias(k) for k in KINDS]
    words = F.when(F.col("text").rlike(HOLDS_WORD), _found("word", WORD)).otherwise(F.array().cast(_EMPTY)).alias("words")
    found = stage(src.select("id", F.xxhash64("id", "text").alias("dk"), *cols, words), "pii-spans")
    extra = (discover(found, rounds, min_confidence, min_seeds, smooth)
             .groupBy("dk").agg(F.sort_array(F.collect_list(F.struct("kind", "start", "end", "token"))).alias("found")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,token:string>>")
    return (found.join(extra, "dk", "left")
            .select(F.col("id").alias(id_col), *KINDS, F.coalesce("found", none).alias("found")))


def digest(spans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found)
    of the result of :func:`find_pii`: spans are kind:start:end, by kind as
    listed, then start."""
    def text(arr, kind):
        return F.transform(arr, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))

    def both(k):
        extra = F.transform(F.filter("found", lambda s: s["kind"] == k), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        base = F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return text(F.array_sort(F.concat(base, extra)), k)

    base = F.array_join(F.concat(*[text(F.col(k), k) for k in KINDS]), ",")
    return spans.select(id_col, *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(base.cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.concat(*[both(k) for k in KINDS]), ",").alias("spans"),
                        F.size("found").cast("long").alias("n_found"))
