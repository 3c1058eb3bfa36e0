"""Registered queries over the test tables (region .. conversations parquet).

Every query reads whole tables, or data Spark derives from them. Arrays are
joined to text ("|") at this edge so that results compare across engines;
IV / PSI doubles are rounded to 12 decimals here for the same reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from featurelens.functions.calendar import epoch_day
from featurelens.operators import (aggregates as agg, calendar as cal, columns as cols,
                                   drift, encoding as enc, iv, joins, profile, sampling, windows)
from featurelens.plans import features as feats, model as mdl
from featurelens.spec import FeatureSpec

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
R = 12  # decimals for log-based doubles at the comparison edge


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _events_nulled(spark, sf):
    """events with value NULL where value <= 50 (a sparse numeric column)."""
    e = _t(spark, sf, "events")
    return e.withColumn("value", F.when(F.col("value") > 50, F.col("value")))


def _join_arr(c):
    return F.array_join(F.col(c), "|").alias(c)


def _orders_feat(spark, sf):
    o = _t(spark, sf, "orders")
    return o.withColumn("o_prio", F.substring("o_orderpriority", 1, 1).cast("int"))


IV_PLAN = iv.BinPlan(("o_totalprice", "o_custkey"), ("o_prio",), ("o_orderpriority",))
ORDER_SPEC = FeatureSpec(cust_key="o_custkey", pkeys=("o_orderkey", "o_custkey"),
                         dkeys=("o_orderdate", "month", "week", "month_idx", "week_idx"),
                         label="o_orderstatus", drop_cols=(), date_col="o_orderdate")


def _iv_verbose(spark, sf):
    return iv.iv_verbose(_orders_feat(spark, sf), "o_orderstatus", IV_PLAN, edge_decimals=6)


def _round_iv(df):
    return df.withColumn("iv", F.round("iv", R))


def _lookahead(spark, sf, days=(0, 8), out="next_7_day_labels"):
    return windows.lookahead_labels(_t(spark, sf, "events"), "user_id", "ts", "event_type", days, out)


def _labels(spark, sf):
    return windows.explode_labels(_lookahead(spark, sf)).drop("next_7_day_labels")


def _purchase_snapshot(spark, sf):
    e = _t(spark, sf, "events").where(F.col("event_type") == "purchase")
    return (e.groupBy("user_id", F.to_date("ts").alias("as_of_dt"))
             .agg(F.sum("value").alias("bal"), F.count(F.lit(1)).alias("n_purch")))


def _daily_facts(spark, sf):
    e = _t(spark, sf, "events")
    return (e.groupBy("user_id", F.to_date("ts").alias("as_of_dt"))
             .agg(F.count(F.lit(1)).alias("n_events"), F.sum("value").alias("total_value")))


def _weekly_events(spark, sf):
    return cal.week_bins(_t(spark, sf, "events"), "ts")


def _monthly_orders(spark, sf):
    return cal.period_columns(_t(spark, sf, "orders"), "o_orderdate")


def _psi_out(p):
    return p.select("label", "period", "period_idx", F.round("psi_raw", R).alias("psi_raw"))


def _orders_split(spark, sf, pct=20, seed=33):
    return sampling.split_by_customer(_t(spark, sf, "orders"), "o_custkey", pct, seed)


def _date_texts(spark, sf):
    """The order date as text in many formats; a mixed and a plain text column."""
    d = F.col("o_orderdate")
    out = {n: F.date_format(d, f) for n, f in (
        ("us", "MM/dd/yyyy"), ("eu", "dd/MM/yyyy"), ("slash", "yyyy/MM/dd"), ("dot", "dd.MM.yyyy"), ("dash", "dd-MM-yyyy"),
        ("day_name", "d MMM yyyy"), ("name_day", "MMMM d, yyyy"), ("compact", "yyyyMMdd"), ("stamp", "M/d/yyyy HH:mm:ss"))}
    out["epoch"] = (F.unix_timestamp(d) + 1_000_000_000).cast("string")
    out["mixed"] = F.when(F.col("o_orderkey") % 2 == 0, out["us"]).otherwise(out["dot"])
    out["words"] = F.col("o_orderpriority")
    return _t(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in out.items()])


def _many_labels(spark, sf):
    """events with up to 3,000 labels, some NULL and some NULL users."""
    return _t(spark, sf, "events").select(
        F.when(F.col("user_id") % 10 != 0, F.col("user_id")).alias("user_id"), "ts",
        F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("L"), (F.col("event_id") % 3000).cast("string"))).alias("lab"))


def _null_keys(spark, sf):
    return _t(spark, sf, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_linenumber") > 2, F.col("l_linenumber")).alias("line"), "l_extendedprice")


def _scores(spark, sf):
    o = _t(spark, sf, "orders")
    lab = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return o.select(lab.alias("y"),
                    (F.col("o_totalprice") / 500000).alias("p0"),
                    (F.substring("o_orderpriority", 1, 1).cast("double") / 5).alias("p1"),
                    (F.dayofyear("o_orderdate").cast("double") / 366).alias("p2"))


def _iv_importance(spark, sf):
    """Importance table derived from IV: gain = sum of IV over labels,
    split = number of bins (stands in for a model's importance)."""
    o = _t(spark, sf, "orders")
    plan = iv.BinPlan(("o_totalprice",), (), ("o_orderpriority",))
    v = iv.iv_verbose(o, "o_orderstatus", plan, edge_decimals=6)
    return v.groupBy(F.col("var").alias("feature")).agg(
        F.round(F.sum("iv"), R).alias("gain_importance"),
        F.count_distinct("bin").alias("split_importance"))


_RUNS: dict = {}


def _run(spark, sf):
    """The model run over the orders, made once per session and folder: labels
    are covered, the test rows are the eval set, every iteration is in the
    curve, and the report is saved."""
    from featurelens.session import scratch_dir
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        _RUNS[key] = mdl.run_model_pipeline(_t(spark, sf, "orders"), ORDER_SPEC, 1, scratch_dir(spark, "model_run"), "orders",
                                            keys=("o_orderkey",), parallelism=3, cover_order=("o_orderkey",), every_iteration=True)
    return _RUNS[key]


def build() -> dict:
    q = {}

    # --- 2.1 sources / sinks -------------------------------------------------
    q["read_table"] = lambda s, sf: _t(s, sf, "orders")
    q["stringify_temporal"] = lambda s, sf: cols.stringify_temporal(_t(s, sf, "orders"))
    q["with_key_counts"] = lambda s, sf: agg.with_key_counts(_t(s, sf, "orders"), "o_custkey")

    def write_table(s, sf):
        from featurelens.session import scratch_dir
        from featurelens.sources.tables import write_table as wt
        p = wt(_t(s, sf, "orders"), scratch_dir(s, "write_table"))
        return s.read.parquet(p)
    q["write_table"] = write_table

    def sample_table_to_path(s, sf):
        from featurelens.session import scratch_dir
        from featurelens.sources.tables import sample_table_to_path as st
        df, _p = st(s, f"{sf.rstrip('/')}/orders.parquet", 2000, 111, ["o_orderkey"],
                    out_path=scratch_dir(s, "orders_sample"))
        return df
    q["sample_table_to_path"] = sample_table_to_path

    def write_report(s, sf):
        from featurelens.session import scratch_dir
        from featurelens.sources.reports import read_report, write_report as wr
        base = scratch_dir(s, "report")
        o = _t(s, sf, "orders")
        wr({"label_counts": iv.label_counts(o, "o_orderstatus"),
            "date_bounds": agg.date_bounds(o, "o_orderdate")}, base, "orders_report")
        wr({"label_counts": iv.label_counts(o, "o_orderpriority")}, base, "orders_report")
        return read_report(s, base, "orders_report", "label_counts").select("label", "count")
    q["write_report"] = write_report

    def save_artefacts(s, sf):
        from featurelens.session import scratch_dir
        from featurelens.sources.reports import load_artefacts, save_artefacts as sa
        p = scratch_dir(s, "artefacts")
        part = _t(s, sf, "part")
        sa(enc.encode_categories_map(part, ["p_brand", "p_type"]), p)
        sa(enc.label_map(_t(s, sf, "orders"), "o_orderstatus"), p)
        # second write of the same (artefact, kind) replaces only that partition
        sa(enc.label_map(_t(s, sf, "orders"), "o_orderstatus"), p)
        return load_artefacts(s, p, "training").drop("rest")
    q["save_artefacts"] = save_artefacts

    # --- 2.2 projections, filters -------------------------------------------
    q["select_cols"] = lambda s, sf: cols.select_cols(_t(s, sf, "lineitem"), ["l_orderkey", "l_quantity", "l_shipdate"])
    q["drop_cols"] = lambda s, sf: cols.drop_cols(_t(s, sf, "orders"), ["o_orderpriority", "o_custkey"])
    q["prefix_columns"] = lambda s, sf: cols.prefix_columns(_t(s, sf, "customer"), "sa_dly_", ["c_custkey"])
    q["between_dates"] = lambda s, sf: cols.between_dates(_t(s, sf, "orders"), "o_orderdate", "1996-01-01", "1996-12-31")
    q["half_open_dates"] = lambda s, sf: cols.half_open_dates(_t(s, sf, "events"), "ts", "2024-01-15", "2024-01-25", 7)
    q["not_null"] = lambda s, sf: cols.not_null(_events_nulled(s, sf), "value")
    q["cast_decimals"] = lambda s, sf: cols.cast_decimals(_t(s, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(15,2)").alias("price")))
    q["fill_numeric"] = lambda s, sf: cols.fill_numeric(_events_nulled(s, sf).select("event_id", "value"), ["value"], 0)
    q["fill_categorical"] = lambda s, sf: cols.fill_categorical(_t(s, sf, "events").select(
        "event_id", F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type")), ["event_type"], "NAN")
    def _const_frame(s, sf):
        o = _t(s, sf, "orders")
        return o.select("o_orderkey", "o_totalprice", "o_orderpriority", F.lit(0).alias("z"),
                        F.lit(None).cast("double").alias("nul"), F.lit("x").alias("const"))
    q["valid_features"] = lambda s, sf: cols.valid_features(profile.data_summary(_const_frame(s, sf)))
    q["features_by_proposed_type"] = lambda s, sf: cols.features_by_proposed_type(
        profile.data_summary(_t(s, sf, "orders")), "numerical")
    q["one_vs_rest_label"] = lambda s, sf: cols.one_vs_rest_label(
        _t(s, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus", "F")
    q["derive_dates"] = lambda s, sf: _t(s, sf, "events").select(
        "event_id", F.to_date("ts").alias("date"), F.unix_timestamp(F.to_date("ts")).alias("unix_date"),
        epoch_day("ts").alias("epoch_day"))

    # --- 2.3 joins -------------------------------------------------------------
    q["join_mapping"] = lambda s, sf: joins.join_mapping(
        _t(s, sf, "events").select("event_id", "user_id", "event_type"),
        _t(s, sf, "customer").select("c_custkey", "c_mktsegment"), "user_id", "c_custkey", "c_custkey")
    q["join_features"] = lambda s, sf: joins.join_features(
        _labels(s, sf), _daily_facts(s, sf).withColumnRenamed("as_of_dt", "date"), ["user_id", "date"])
    q["lagged_join"] = lambda s, sf: joins.lagged_join(
        _daily_facts(s, sf).select("user_id", F.col("as_of_dt").alias("date"), F.col("n_events").alias("n_today")),
        _daily_facts(s, sf).select("user_id", "as_of_dt", F.col("n_events").alias("n_yesterday")),
        "user_id", "as_of_dt")
    q["customer_membership_join"] = lambda s, sf: joins.customer_membership_join(
        _t(s, sf, "orders"),
        sampling.split_by_customer(_t(s, sf, "customer"), "c_custkey").where(F.col("split") == "train")
        .select(F.col("c_custkey").alias("o_custkey")), "o_custkey")
    q["labels_not_in"] = lambda s, sf: joins.labels_not_in(
        _t(s, sf, "orders").select(F.year("o_orderdate").cast("string").alias("yr")),
        _t(s, sf, "orders").where(F.col("o_orderdate") < "1999-01-01").select(
            F.year("o_orderdate").cast("string").alias("yr")), "yr")
    q["ffill_join"] = lambda s, sf: feats.snapshot_features(
        _labels(s, sf), _purchase_snapshot(s, sf), "user_id", "as_of_dt", ["bal", "n_purch"])
    q["snapshot_features"] = lambda s, sf: feats.snapshot_features(
        _labels(s, sf), _purchase_snapshot(s, sf), "user_id", "as_of_dt", ["bal", "n_purch"],
        start="2024-01-05", end="2024-01-25")

    # --- 2.4 aggregations -----------------------------------------------------
    q["agg_numeric"] = lambda s, sf: agg.agg_numeric(
        _t(s, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_discount", "l_tax"]).select(
        "l_returnflag", *[F.round(c, 6).alias(c) for c in
                          [f"{x}_{f}" for x in ["l_quantity", "l_discount", "l_tax"]
                           for f in ["min", "mean", "max", "std", "sum"]]])
    q["agg_numeric_median"] = lambda s, sf: agg.agg_numeric(
        _t(s, sf, "lineitem"), "l_returnflag", ["l_quantity", "l_extendedprice"], ("sum", "median")).select(
        "l_returnflag", *[F.round(c, 6).alias(c) for c in
                          ["l_quantity_sum", "l_quantity_median", "l_extendedprice_sum", "l_extendedprice_median"]])
    # NULL groups have medians and quartiles of their own
    q["agg_numeric_nulls"] = lambda s, sf: _round_all(agg.agg_numeric(
        _null_keys(s, sf), ["flag", "line"], ["l_extendedprice"], ("min", "max", "median")), 6)
    q["describe_by_nulls"] = lambda s, sf: _round_all(iv.describe_by(_null_keys(s, sf), "flag", "l_extendedprice"), 6)
    q["freq_table"] = lambda s, sf: agg.freq_table(_t(s, sf, "part"), "p_type")
    # NULLs: every third part has no type
    q["freq_table_nulls"] = lambda s, sf: agg.freq_table(_t(s, sf, "part").select(
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_type")).alias("p_type")), "p_type")
    q["cumulative_share"] = lambda s, sf: agg.cumulative_share(
        agg.freq_table(_t(s, sf, "part"), "p_type"), "p_type")
    q["date_bounds"] = lambda s, sf: agg.date_bounds(_t(s, sf, "orders"), "o_orderdate")
    q["label_counts"] = lambda s, sf: iv.label_counts(_t(s, sf, "orders"), "o_orderstatus")
    q["describe_by"] = lambda s, sf: _round_all(iv.describe_by(
        _t(s, sf, "lineitem"), "l_returnflag", "l_extendedprice"), 6)
    q["crosstab_margins"] = lambda s, sf: drift.crosstab_margins(
        _weekly_events(s, sf), "event_type", "week", "user_id", "week_idx").drop("all_labels", "all_periods")
    q["crosstab_ratio"] = lambda s, sf: drift.crosstab_ratio(drift.crosstab_margins(
        _weekly_events(s, sf), "event_type", "week", "user_id", "week_idx")).drop("all_labels", "all_periods")
    # many labels, sparse cells, a label and a period named like the totals
    q["crosstab_sparse"] = lambda s, sf: drift.crosstab_ratio(drift.crosstab_margins(
        _t(s, sf, "documents").select(
            F.when(F.col("source") == "src1", "All").when(F.col("source") != "src2", F.col("source")).alias("source"),
            F.when(F.col("lang") == "de", "All").otherwise(F.col("lang")).alias("lang"), "doc_id"),
        "source", "lang", "doc_id")).drop("all_labels", "all_periods")
    q["history_pivot"] = lambda s, sf: windows.history_pivot(
        _t(s, sf, "events"), "user_id", "ts", "event_type", EVENT_TYPES)
    q["split_counts"] = lambda s, sf: sampling.split_counts(_orders_split(s, sf), "o_custkey")

    def label_distribution(s, sf):
        x, _m = enc.label_encode(_orders_split(s, sf), "o_orderstatus")
        return sampling.label_distribution(x, "o_orderstatus_idx", "split", "o_orderstatus")
    q["label_distribution"] = label_distribution
    q["label_distribution_nulls"] = lambda s, sf: sampling.label_distribution(
        _orders_split(s, sf).withColumn("lab", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderpriority"))), "lab")

    # --- 2.5 windows ----------------------------------------------------------
    q["lookahead_labels"] = lambda s, sf: _lookahead(s, sf).select("user_id", "date", _join_arr("next_7_day_labels"))
    q["lookahead_labels_gap"] = lambda s, sf: _lookahead(s, sf, (3, 10), "next_7_day_labels_with_gap").select(
        "user_id", "date", _join_arr("next_7_day_labels_with_gap"))
    q["explode_labels"] = lambda s, sf: windows.explode_labels(_lookahead(s, sf)).select(
        "user_id", "date", _join_arr("next_7_day_labels"), "label")
    q["history_list"] = lambda s, sf: windows.history_list(
        _t(s, sf, "events"), "user_id", "ts", "event_type").select(
        "user_id", "date", F.array_join(F.transform("historical_interactions", lambda x: F.concat(
            x["intent"], F.lit(":"), x["n"].cast("string"))), "|").alias("historical_interactions"))
    q["explode_history"] = lambda s, sf: windows.history_rows(_t(s, sf, "events"), "user_id", "ts", "event_type")
    # the list with its repeats; a map of counts for any number of intents
    q["history_sorted_list"] = lambda s, sf: windows.history_list(
        _t(s, sf, "events"), "user_id", "ts", "event_type", repeats=True).select("user_id", "date", _join_arr("historical_interactions"))
    q["history_map"] = lambda s, sf: windows.history_pivot(_many_labels(s, sf), "user_id", "ts", "lab").select(
        "user_id", "date", F.array_join(F.transform(F.array_sort(F.map_entries("counts")), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))), "|").alias("counts"), "null")
    q["lookahead_many_labels"] = lambda s, sf: windows.lookahead_labels(_many_labels(s, sf), "user_id", "ts", "lab").select(
        "user_id", "date", _join_arr("next_7_day_labels"))
    q["forward_fill"] = lambda s, sf: windows.forward_fill(
        _events_nulled(s, sf).select("event_id", "user_id", "ts", "value"), "user_id", ["ts", "event_id"],
        ["value"])
    # without users or times for every seventh event: NULL keys and NULL orders
    q["forward_fill_nulls"] = lambda s, sf: windows.forward_fill(_events_nulled(s, sf).select(
        "event_id", F.when(F.col("event_id") % 7 != 0, F.col("user_id")).alias("user_id"),
        F.when(F.col("event_id") % 11 != 0, F.col("ts")).alias("ts"), "value"), "user_id", ["ts", "event_id"], ["value"])
    q["psi"] = lambda s, sf: _psi_out(drift.psi(drift.crosstab_ratio(drift.crosstab_margins(
        _weekly_events(s, sf), "event_type", "week", "user_id", "week_idx"))))
    q["psi_monthly"] = lambda s, sf: _psi_out(drift.psi(drift.crosstab_ratio(drift.crosstab_margins(
        _monthly_orders(s, sf), "o_orderstatus", "month", "o_custkey", "month_idx"))))

    def label_report(s, sf):
        t = drift.label_report(_t(s, sf, "events"), "user_id", "event_type", "ts")
        parts = []
        for name, df in t.items():
            x = df
            for c, typ in (("n", "long"), ("ratio", "double"), ("psi_raw", "double")):
                if c not in x.columns:
                    x = x.withColumn(c, F.lit(None).cast(typ))
            parts.append(x.select(F.lit(name).alias("table"), "label", "period", "period_idx", "n",
                                  "ratio", F.round("psi_raw", R).alias("psi_raw")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    q["label_report"] = label_report

    # --- 2.6 sorts / top-k ----------------------------------------------------
    q["sort_report"] = lambda s, sf: _round_iv(iv.sort_bins(_iv_verbose(s, sf)))
    q["top_iv_bins"] = lambda s, sf: _round_iv(iv.iv_review(
        _orders_feat(s, sf), "o_orderstatus", _iv_verbose(s, sf))["max_bins"])
    q["dedup_rows"] = lambda s, sf: _t(s, sf, "events").select(
        "user_id", F.to_date("ts").alias("date"), "event_type").dropDuplicates()

    # --- 2.8 calendar ---------------------------------------------------------
    q["week_bins"] = lambda s, sf: _weekly_events(s, sf).select("event_id", "user_id", "week", "week_idx")
    q["month_bins"] = lambda s, sf: cal.month_bins(_t(s, sf, "orders"), "o_orderdate").select(
        "o_orderkey", "month", "month_idx")
    q["period_columns"] = lambda s, sf: _monthly_orders(s, sf).select(
        "o_orderkey", "month", "month_idx", "week", "week_idx")
    q["period_columns_weeks_only"] = lambda s, sf: cal.period_columns(_t(s, sf, "events"), "ts").select(
        "event_id", "month", "month_idx", "week", "week_idx")

    # --- 2.10 summary, profile, IV -------------------------------------------
    q["data_summary"] = lambda s, sf: profile.data_summary(_t(s, sf, "orders")).withColumn(
        "samples", F.array_join("samples", "|"))
    q["data_profile"] = lambda s, sf: profile.data_profile(_t(s, sf, "part")).withColumn(
        "sample_values", F.array_join("sample_values", "|"))
    q["profile_table"] = lambda s, sf: profile.profile_table(
        _t(s, sf, "orders"), "o_orderdate", "1996-01-01", "1996-12-31", with_explored_date=False).withColumn(
        "sample_values", F.array_join("sample_values", "|"))
    q["is_date_field"] = lambda s, sf: profile.column_stats(_t(s, sf, "events").select(
        F.to_date("ts").cast("string").alias("day"), "event_type", "props")).select("var", "is_date_field")
    # ids, dates and mixed text; integers beyond 2^53
    q["is_date_field_text"] = lambda s, sf: profile.column_stats(_t(s, sf, "orders").select(
        F.lpad(F.col("o_orderkey").cast("string"), 6, "1").alias("digits"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("stamp"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("none").alias("mixed")
        )).select("var", "is_date_field")
    q["date_formats"] = lambda s, sf: profile.column_stats(_date_texts(s, sf).drop("o_orderkey")).select("var", "is_date_field", "date_format")
    q["derive_dates_text"] = lambda s, sf: profile.convert_dates(_date_texts(s, sf))[0].drop("mixed", "words")
    # long texts, many with the same beginning
    q["data_summary_texts"] = lambda s, sf: profile.data_summary(_t(s, sf, "documents")).withColumn(
        "samples", F.array_join("samples", "|"))
    q["value_range_long"] = lambda s, sf: profile.data_profile(_t(s, sf, "orders").select(
        (F.col("o_orderkey") + 9007199254740993).alias("big"))).select("feature_name", "range_of_features")
    q["between_stamps"] = lambda s, sf: cols.between_dates(_t(s, sf, "events"), "ts", "2024-01-05", "2024-01-10").select("event_id", "ts")
    q["value_range"] = lambda s, sf: profile.data_profile(_t(s, sf, "lineitem")).select(
        "feature_name", "range_of_features")
    q["quantile_bins"] = lambda s, sf: iv.quantile_bins(
        _t(s, sf, "lineitem"), ["l_extendedprice", "l_quantity", "l_discount"], edge_decimals=6)
    q["iv_verbose"] = lambda s, sf: _round_iv(_iv_verbose(s, sf))
    q["iv_summary"] = lambda s, sf: _round_iv(iv.iv_summary(_iv_verbose(s, sf)))
    q["iv_strength"] = lambda s, sf: _round_iv(iv.iv_strength(iv.iv_summary(_iv_verbose(s, sf))))

    def iv_all(s, sf):
        o = _t(s, sf, "orders").select("o_orderstatus", "o_totalprice", "o_orderpriority", "o_custkey")
        v, sm = iv.iv_all(o, "o_orderstatus", profile.data_summary(o), edge_decimals=6)
        return _round_iv(sm)
    q["iv_all"] = iv_all
    # some thousand labels
    q["iv_many_labels"] = lambda s, sf: iv.iv_summary(iv.iv_verbose(
        _t(s, sf, "orders").withColumn("lab", F.col("o_custkey") % 3000), "lab",
        iv.BinPlan(("o_totalprice",), (), ("o_orderpriority",)), edge_decimals=6)).withColumn("iv", F.round("iv", 9))
    # NULLs in a short integer column, and in the label
    q["iv_nulls"] = lambda s, sf: _round_iv(iv.iv_verbose(_t(s, sf, "part").select(
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")).alias("p_brand"),
        F.when(F.col("p_size") > 5, F.col("p_size") % 7).cast("tinyint").alias("size"),
        F.when(F.col("p_size") < 40, F.col("p_type")).alias("p_type")), "p_brand",
        iv.BinPlan((), ("size",), ("p_type",))))
    for out in ("adjusted", "describe_significant", "high_bins", "useful", "label_counts"):
        q[f"iv_review_{out}"] = (lambda name: lambda s, sf: _round_all(iv.iv_review(
            _orders_feat(s, sf), "o_orderstatus", _iv_verbose(s, sf))[name], R))(out)

    def iv_documents(s, sf):
        d = _t(s, sf, "labels").join(_t(s, sf, "documents").select("doc_id", "lang", "source", "n_chars"), "doc_id")
        v = iv.iv_verbose(d, "quality", iv.BinPlan(("n_chars",), (), ("lang", "source")), edge_decimals=6)
        return _round_iv(iv.iv_strength(iv.iv_summary(v)))
    q["iv_documents"] = iv_documents
    q["iv_review"] = lambda s, sf: _round_all(iv.iv_review(
        _orders_feat(s, sf), "o_orderstatus", _iv_verbose(s, sf))["describe"], R)

    # --- 2.11 sampling, splitting ---------------------------------------------
    q["sample_n"] = lambda s, sf: sampling.sample_n(_t(s, sf, "orders"), 2000, 111, ["o_orderkey"])
    q["stratified_sample"] = lambda s, sf: sampling.stratified_sample(
        _t(s, sf, "orders"), "o_orderstatus", 200, 111, ["o_orderkey"])
    q["split_by_customer_exact"] = lambda s, sf: sampling.split_by_customer_exact(
        _t(s, sf, "orders"), "o_custkey").select("o_orderkey", "o_custkey", "split")
    q["split_by_customer"] = lambda s, sf: _orders_split(s, sf).select("o_orderkey", "o_custkey", "split")
    q["split_in_time"] = lambda s, sf: sampling.split_in_time(
        _t(s, sf, "orders"), "o_orderdate", "o_custkey", "1996-01-01", "1999-01-01", "1999-01-01",
        "2000-12-31").select("o_orderkey", "o_custkey", "o_orderdate", "split")

    def train_test_oos(s, sf):
        out, _m, _unknown = feats.train_test_oos(
            _t(s, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"),
            "o_orderdate", "o_custkey", "o_orderstatus", "1996-01-01", "1999-01-01", "1999-01-01", "2000-12-31")
        return out.select("o_orderkey", "split", "o_orderstatus", "o_orderstatus_idx")
    q["train_test_oos"] = train_test_oos

    def cover_labels(s, sf):
        o = sampling.split_by_customer(_t(s, sf, "orders"), "o_custkey", 2).select(
            "o_orderkey", "split", F.floor(F.col("o_totalprice") / 25000).cast("int").cast("string").alias("lab"))
        out, _a, _b = sampling.cover_labels(o, "lab", "split", ["o_orderkey"])
        return out
    q["cover_labels"] = cover_labels

    # --- 2.12 encoding --------------------------------------------------------
    def label_encode(s, sf):
        x, _m = enc.label_encode(_t(s, sf, "orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus")
        return x
    q["label_encode"] = label_encode

    def label_encode_score(s, sf):
        o = _t(s, sf, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("yr"))
        m = enc.label_map(o.where(F.col("yr") < "1999"), "yr")
        x, _unknown = enc.label_encode_score(o.where(F.col("yr") >= "1998"), "yr", m)
        return x
    q["label_encode_score"] = label_encode_score

    def index_categories(s, sf):
        x, _m = enc.index_categories(_t(s, sf, "part").select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"])
        return x
    q["index_categories"] = index_categories

    def encode_train(s, sf):
        x, _m = enc.encode_categories_train(_t(s, sf, "part").select("p_partkey", "p_brand", "p_type"),
                                            ["p_brand", "p_type"])
        return x
    q["encode_categories_train"] = encode_train

    def encode_named_like_the_rest(s, sf):
        """A brand is called least_perc; five columns by one dictionary."""
        p = _t(s, sf, "part")
        named = F.when(F.col("p_brand") == "Brand#11", "least_perc").when(F.col("p_size") > 2, F.col("p_brand"))
        x, _m = enc.encode_categories_train(p.select("p_partkey", named.alias("brand"), "p_type", F.col("p_size").cast("string").alias("size")), ["brand", "p_type", "size"])
        return x
    q["encode_named_like_the_rest"] = encode_named_like_the_rest

    def lookup_maps(s, sf):
        p = _t(s, sf, "part").select("p_partkey", "p_brand", "p_type")
        m = enc.index_categories_map(p.where("p_partkey % 2 = 0"), ["p_brand", "p_type"])
        return joins.lookup_maps(p, ["p_brand", "p_type"], m)
    q["lookup_maps"] = lookup_maps

    def encode_score(s, sf):
        p = _t(s, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
        m = enc.encode_categories_map(p.where(F.col("p_size") <= 25), ["p_brand", "p_type"])
        return enc.encode_categories_score(p.where(F.col("p_size") > 25), ["p_brand", "p_type"], m)
    q["encode_categories_score"] = encode_score

    def lookup_map(s, sf):
        o = _t(s, sf, "orders")
        m = enc.label_map(o.where(F.col("o_orderdate") < "1998-01-01"), "o_orderpriority")
        return joins.lookup_map(o.select("o_orderkey", "o_orderpriority"), "o_orderpriority",
                                m.select("value", "code"))
    q["lookup_map"] = lookup_map

    # --- 2.13 pipelines, model ------------------------------------------------
    q["label_dataset"] = lambda s, sf: feats.label_dataset(
        _t(s, sf, "events"), _t(s, sf, "customer").select("c_custkey", "c_nationkey"),
        "user_id", "ts", "event_type", "user_id", "c_custkey", "c_custkey").select(
        "user_id", "date", _join_arr("next_7_day_labels"), "label", "c_custkey", "c_nationkey")
    q["interaction_features"] = lambda s, sf: feats.interaction_features(
        _labels(s, sf), _t(s, sf, "events"), "user_id", "ts", "event_type", EVENT_TYPES,
        start="2024-01-10", end="2024-01-31")
    q["transaction_features"] = lambda s, sf: feats.transaction_features(
        _labels(s, sf), _daily_facts(s, sf).withColumn("batchid", F.lit(1)), "user_id", "as_of_dt")

    def prepare_features(s, sf):
        prep = feats.prepare_features(_t(s, sf, "orders"), ORDER_SPEC)
        return prep.df.select("o_orderkey", "o_totalprice", "o_orderpriority", "month_idx", "week_idx")
    q["prepare_features"] = prepare_features

    def feature_report(s, sf):
        summ = profile.data_summary(_t(s, sf, "orders"))
        return mdl.feature_report(summ, _iv_importance(s, sf), ORDER_SPEC, 1)
    q["feature_report"] = feature_report
    q["auc_mu"] = lambda s, sf: mdl.auc_mu_pairs(_scores(s, sf), "y", ["p0", "p1", "p2"]).withColumn(
        "auc", F.round("auc", R))

    q["auc_mu_mean"] = lambda s, sf: mdl.auc_mu(_scores(s, sf), "y", ["p0", "p1", "p2"]).withColumn(
        "auc_mu", F.round("auc_mu", R))
    q["train_ova_model"] = lambda s, sf: mdl.model_scores(_run(s, sf).trained, "test")
    q["learning_curve"] = lambda s, sf: _run(s, sf).learning
    q["feature_importance"] = lambda s, sf: _run(s, sf).importance

    def save_feature_report(s, sf):
        from featurelens.sources.reports import read_report
        return read_report(s, _run(s, sf).base, "orders", "feature_selection_report")
    q["save_feature_report"] = save_feature_report

    def saved(section):
        def run(s, sf):
            from featurelens.sources.reports import read_report
            return read_report(s, _run(s, sf).base, "orders", section)
        return run
    # sections of the saved report that SQL can compute
    q["saved_split_counts"] = saved("train_test_count")
    q["saved_label_distribution"] = saved("label_dist")

    def model_run(s, sf):
        """The countable part of a whole run: scored test rows per class,
        iterations per class, pairs of classes, rows of the saved sections."""
        from featurelens.sources.reports import read_report
        run = _run(s, sf)
        base = run.base
        scored = mdl.model_scores(run.trained, "test").where("score_0 is not null")
        parts = [scored.groupBy(F.col("o_orderstatus_idx").cast("string").alias("key")).agg(F.count_distinct("o_orderkey").alias("n"))
                 .select(F.lit("scored").alias("part"), "key", "n"),
                 run.learning.groupBy(F.col("class").cast("string").alias("key")).agg(F.max("iteration").cast("long").alias("n"))
                 .select(F.lit("iterations").alias("part"), "key", "n"),
                 run.auc_mu.select(F.lit("auc").alias("part"), F.lit("pairs").alias("key"), F.col("pairs").cast("long").alias("n"))]
        for name in ("data_summary", "train_test_count", "label_dist", "learning_details", "feature_selection_report"):
            parts.append(read_report(s, base, "orders", name).agg(F.count(F.lit(1)).alias("n"))
                         .select(F.lit("section").alias("part"), F.lit(name).alias("key"), "n"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    q["model_run"] = model_run

    def retrain(s, sf):
        from featurelens.session import scratch_dir
        path = scratch_dir(s, "retrain")
        p = _t(s, sf, "part").select("p_partkey", "p_brand", "p_type", "p_size")
        enc.label_encode_retrain(p, "p_brand", path)
        enc.encode_categories_retrain(p.where(F.col("p_size") <= 25), ["p_brand", "p_type"], path)
        return enc.encode_categories_retrain_score(p.where(F.col("p_size") > 25), ["p_brand", "p_type"], path)
    q["encode_categories_retrain"] = retrain
    return {k: _dates_as_text(v) for k, v in q.items()}


def _dates_as_text(fn):
    """DATE columns as ISO text at the comparison edge (engines hand dates
    to pandas as different Python types); the operators keep DateType."""
    def run(spark, sf):
        df = fn(spark, sf)
        if not any(f.dataType.simpleString() == "date" for f in df.schema.fields):
            return df
        return df.select(*[F.col(f.name).cast("string").alias(f.name) if f.dataType.simpleString() == "date"
                           else F.col(f.name) for f in df.schema.fields])
    run.__doc__ = fn.__doc__
    return run


def _round_all(df: DataFrame, d: int) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), d).alias(f.name) if f.dataType.simpleString() == "double"
                       else F.col(f.name) for f in df.schema.fields])


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Which columns separate the order states? Summary -> bins -> IV -> band."""
    o = _t(spark, sf, "orders")
    feats_ = ["o_totalprice", "o_orderpriority", "o_custkey"]
    _v, sm = iv.iv_all(o.select("o_orderstatus", *feats_), "o_orderstatus",
                       profile.data_summary(o.select(*feats_)))
    return iv.iv_strength(sm)
