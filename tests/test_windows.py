import datetime as dt

from featurelens.operators import windows


def _d(i):
    return dt.date(2024, 1, 1) + dt.timedelta(days=i - 1)


def _events(spark, rows):
    return spark.createDataFrame([(u, _d(d), it) for u, d, it in rows], "u int, ts date, intent string")


def test_lookahead_fixture(spark):
    df = _events(spark, [(1, 1, "A"), (1, 9, "B"), (1, 10, "C")])
    got = {r["date"]: r["next_7_day_labels"] for r in
           windows.lookahead_labels(df, "u", "ts", "intent").collect()}
    assert got == {_d(1): ["A", "B"], _d(9): ["B", "C"], _d(10): ["C"]}
    gap = {r["date"]: r["g"] for r in
           windows.lookahead_labels(df, "u", "ts", "intent", (3, 10), "g").collect()}
    assert gap == {_d(1): ["B", "C"], _d(9): [], _d(10): []}


def test_explode_labels_rows(spark):
    df = _events(spark, [(1, 1, "A"), (1, 1, "A"), (1, 2, "B")])
    ex = windows.explode_labels(windows.lookahead_labels(df, "u", "ts", "intent"))
    assert ex.count() == ex.distinct().count() == 3


def test_history_pivot_fixture(spark):
    df = _events(spark, [(1, 1, "A"), (1, 1, "A"), (1, 2, "B")])
    got = {r["date"]: (r["A"], r["B"], r["null"]) for r in
           windows.history_pivot(df, "u", "ts", "intent", ["A", "B"]).collect()}
    assert got == {_d(1): (0, 0, 2), _d(2): (2, 0, 0)}
    per_day = {r["date"]: (r["A"], r["B"], r["null"]) for r in
               windows.history_pivot(df, "u", "ts", "intent", ["A", "B"], per_day=True).collect()}
    assert per_day == {_d(1): (0, 0, 1), _d(2): (2, 0, 0)}


def test_history_window_bounds(spark):
    df = _events(spark, [(1, 1, "A"), (1, 61, "B"), (1, 62, "C")])
    got = {r["date"]: (r["A"], r["B"]) for r in
           windows.history_pivot(df, "u", "ts", "intent", ["A", "B"]).collect()}
    assert got[_d(61)] == (1, 0)   # day 1 is 60 days earlier: inside
    assert got[_d(62)] == (0, 1)   # day 1 is 61 days earlier: outside


def test_forward_fill_fixture(spark):
    vals = [None, 3.0, None, 5.0, None]
    rows = [(1, _d(i * 20 + 1), v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k int, d date, v double")
    for parts in (1, 3, 8):
        got = [r["v"] for r in windows.forward_fill(df, "k", ["d"], ["v"], parts).orderBy("d").collect()]
        assert got == [None, 3.0, 3.0, 5.0, 5.0], parts


def _single_window(df, key, order, col):
    from pyspark.sql import Window, functions as F
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(col, F.last(col, ignorenulls=True).over(w))


def test_forward_fill_hot_key_null_keys_and_dates(spark):
    import random
    rnd = random.Random(1)
    rows = [(rnd.choice([0, 0, 0, None, rnd.randint(1, 9)]), rnd.choice([None, _d(rnd.randint(1, 300))]), i,
             rnd.random() if rnd.random() < 0.2 else None) for i in range(2000)]
    df = spark.createDataFrame(rows, "k int, d date, i int, v double")
    a = windows.forward_fill(df, "k", ["d", "i"], ["v"]).orderBy("i").collect()
    b = _single_window(df, "k", ["d", "i"], "v").orderBy("i").collect()
    assert [r["v"] for r in a] == [r["v"] for r in b]
    # idempotent
    c = windows.forward_fill(windows.forward_fill(df, "k", ["d", "i"], ["v"]), "k", ["d", "i"], ["v"]).orderBy("i").collect()
    assert [r["v"] for r in a] == [r["v"] for r in c]


def test_history_pivot_refuses_an_intent_named_like_the_empty_column(spark):
    import pytest
    with pytest.raises(ValueError):
        windows.history_pivot(_events(spark, [(1, 1, "null"), (1, 2, "B")]), "u", "ts", "intent", ["null", "B"])


def test_history_pivot_without_a_list_is_a_map(spark):
    df = _events(spark, [(1, 1, "A"), (1, 1, "A"), (1, 2, "null"), (1, 3, None), (1, 3, "A"), (2, 1, None)])
    got = {(r["u"], r["date"]): (r["counts"], r["null"]) for r in windows.history_pivot(df, "u", "ts", "intent").collect()}
    assert got == {(1, _d(1)): ({}, 2), (1, _d(2)): ({"A": 2}, 0), (1, _d(3)): ({"A": 4, "null": 2}, 0), (2, _d(1)): ({}, 1)}
    once = windows.history_pivot(df, "u", "ts", "intent", per_day=True).where("u = 1").collect()
    assert {r["date"]: r["counts"] for r in once}[_d(3)] == {"A": 2, "null": 1}


def _ranges(rows, lo, hi):
    """Brute force: the intents of each active (user, day) in its range."""
    out = {(u, d): [] for u, d, _ in rows}
    for (u, d), found in out.items():
        found += sorted(i for v, e, i in rows if v == u and i is not None and d is not None and e is not None and lo <= e - d <= hi)
    return out


def test_ranges_equal_brute_force(spark):
    import random
    rnd = random.Random(4)
    rows = [(rnd.choice([None, 0, 0, 0, 1, 2]), rnd.choice([None, *range(1, 200, 3)]) if u else rnd.randint(1, 30), rnd.choice(["a", "b", "b", None, "c"]))
            for u in range(600)]
    df = spark.createDataFrame([(u, None if d is None else _d(d), i) for u, d, i in rows], "u int, ts date, intent string")
    day = lambda d: None if d is None else _d(d)
    for lo, hi in ((0, 8), (3, 10), (-2, 2), (-60, -1)):
        want = _ranges(rows, lo, hi)
        sets = {(r["u"], r["date"]): r["s"] for r in windows.lookahead_labels(df, "u", "ts", "intent", (lo, hi), "s").collect()}
        assert sets == {(u, day(d)): sorted(set(v)) for (u, d), v in want.items()}
        lists = {(r["u"], r["date"]): r["l"] for r in windows.history_list(df, "u", "ts", "intent", (lo, hi), "l", repeats=True).collect()}
        assert lists == {(u, day(d)): v for (u, d), v in want.items()}
    flat = {}
    for r in windows.history_rows(df, "u", "ts", "intent").collect():
        flat.setdefault((r["u"], r["date"]), {})[r["cb_past_intent"]] = r["n_past"]
    want = _ranges(rows, -60, -1)
    assert flat == {(u, day(d)): {i: v.count(i) for i in v} or {None: 0} for (u, d), v in want.items()}


def test_ranges_hold_no_arrays_per_row(spark):
    df = _events(spark, [(1, 1, "A"), (1, 2, "B")])
    plan = windows.history_rows(df, "u", "ts", "intent")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "collect_set" not in plan


def test_many_labels_and_a_hot_user(spark):
    from pyspark.sql import functions as F
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("u"),
                                   F.date_add(F.lit(_d(1)), (F.col("id") % 97).cast("int")).alias("ts"), (F.col("id") % 3000).cast("string").alias("intent"))
    got = windows.lookahead_labels(df, "u", "ts", "intent")
    far = df.select(F.col("u").alias("v"), F.col("ts").alias("t"), "intent").distinct()
    days = df.select("u", "ts").distinct()
    want = (days.join(far, (F.col("u") == F.col("v")) & F.col("t").between(F.col("ts"), F.date_add("ts", 8)))
            .groupBy("u", F.col("ts").alias("date")).agg(F.array_sort(F.collect_set("intent")).alias("next_7_day_labels")))
    assert got.exceptAll(want).count() == 0 and want.count() == got.count() == days.count()


def test_history_list_is_a_multiset(spark):
    df = _events(spark, [(1, 1, "A"), (1, 1, "A"), (1, 2, "B"), (1, 3, "C")])
    got = {r["date"]: [(x["intent"], x["n"]) for x in r["historical_interactions"]]
           for r in windows.history_list(df, "u", "ts", "intent").collect()}
    assert got == {_d(1): [], _d(2): [("A", 2)], _d(3): [("A", 2), ("B", 1)]}
    ex = {(r["date"], r["cb_past_intent"]): r["n_past"] for r in
          windows.explode_history(windows.history_list(df, "u", "ts", "intent")).collect()}
    assert ex == {(_d(1), None): 0, (_d(2), "A"): 2, (_d(3), "A"): 2, (_d(3), "B"): 1}
