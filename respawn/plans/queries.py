"""The registered queries (one per operator family of the inventory)."""

from __future__ import annotations

import datetime as dt

from respawn.operators.silver import CLEANED_COLUMNS
from respawn.plans.catalog import register
from respawn.plans.lakehouse import Lakehouse


@register("churn_features_daily")
def churn_features_daily(h: Lakehouse):
    """K1 (flagship): bronze -> silver -> per-player churn features as of the last day."""
    return h.churn


@register("clean_events")
def clean_events(h: Lakehouse):
    """Typed, normalised, de-duplicated, parsed events."""
    return h.cleaned.select(*CLEANED_COLUMNS)


@register("player_sessions")
def player_sessions(h: Lakehouse):
    """Sessions from session_end events."""
    return h.sessions


@register("purchase_events")
def purchase_events(h: Lakehouse):
    """C4: valid purchases."""
    return h.purchases


# =========================================================================== B: data quality
from pyspark.sql import functions as F  # noqa: E402

from respawn.functions.exact import exact_div, money, money_sum, ratio_round  # noqa: E402
from respawn.operators import bi, dq, gold, ml, profile, silver  # noqa: E402


@register("dq_drop")
def dq_drop(h: Lakehouse):
    """B1: raw rows that pass the three bronze drop rules."""
    return h.bronze


@register("dq_warn")
def dq_warn(h: Lakehouse):
    """B2: cleaned rows kept by warn rules, with the list of warn rules each fails."""
    flagged = dq.expect(h.cleaned_candidates, dq.CLEANED_RULES, flag_column="_failed")
    return flagged.select("event_id", "game_mode", "region", "platform",
                          F.array_join("_failed", ",").alias("dq_failed"))


@register("dq_metrics")
def dq_metrics(h: Lakehouse):
    """Per-rule total/passed/failed/pass_pct for every dataset of the pipeline, one pass a table."""
    parts = [
        dq.rule_metrics(h.raw, dq.RAW_RULES, "raw_events"),
        silver.rule_metrics(h.cleaned_candidates),
        dq.rule_metrics(gold.churn_candidates(h.cleaned, None, None, h.as_of), dq.CHURN_RULES, "churn_features_daily"),
        dq.rule_metrics(gold.arpu_candidates(None, h.cleaned, h.as_of), dq.ARPU_RULES, "arpu_features_daily"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("raw_summary")
def raw_summary(h: Lakehouse):
    """Events, players, days, first/last event of the bronze table."""
    return profile.raw_summary(h.bronze)


@register("null_profile")
def null_profile(h: Lakehouse):
    """NULLs per column of the raw (pre-rule) envelope."""
    return profile.null_profile(h.raw)


@register("event_dist")
def event_dist(h: Lakehouse):
    """Bronze event-type distribution, ordered."""
    return profile.event_distribution(h.bronze)


@register("distinct_types")
def distinct_types(h: Lakehouse):
    """Distinct raw event types reaching bronze."""
    return profile.distinct_values(h.bronze)


@register("bronze_quality")
def bronze_quality(h: Lakehouse):
    """Events / players / missing payloads by raw type."""
    return profile.bronze_quality(h.bronze)


@register("silver_quality_summary")
def silver_quality_summary(h: Lakehouse):
    """Quality summary by event date x type."""
    return profile.silver_quality_summary(h.cleaned)


@register("dup_check")
def dup_check(h: Lakehouse):
    """Duplicates before (bronze) and after (cleaned) de-duplication."""
    return profile.duplicate_check({"bronze": h.bronze, "cleaned": h.cleaned})


@register("cleaned_profile")
def cleaned_profile(h: Lakehouse):
    """Cleaned-table profile."""
    return profile.cleaned_profile(h.cleaned)


# =========================================================================== C5-C7
@register("kill_events")
def kill_events(h: Lakehouse):
    """Kill events with parsed combat fields (whole table, no preview cap)."""
    return silver.kill_events(h.cleaned)


@register("revenue_by_region_platform")
def revenue_by_region_platform(h: Lakehouse):
    """Purchases and revenue by region x platform."""
    return silver.revenue_by_region_platform(h.purchases)


@register("session_metrics")
def session_metrics(h: Lakehouse):
    """Session count, mean duration / K-D / win rate by region x platform."""
    return silver.session_metrics(h.sessions)


# =========================================================================== D: predicates
@register("filter_predicates")
def filter_predicates(h: Lakehouse):
    """Equality, IN, IS NULL, AND/OR and numeric comparisons, pushed into the plan."""
    c = F.col
    cond = (
        ((c("event_type_normalized") == "purchase") & (c("item_price_usd") >= 10.0)
         & c("region").isin("NA", "EU"))
        | ((c("event_type_normalized") == "session_end") & c("session_duration_seconds").isNull())
        | (c("game_mode").isNull() & (c("event_type_normalized") != "logout"))
    )
    return h.cleaned.where(cond).select("event_id", "player_id", "event_type_normalized", "region",
                                        "game_mode", "item_price_usd")


@register("date_window_filter")
def date_window_filter(h: Lakehouse):
    """Events in the inclusive 7-day window ending at the as-of date."""
    lo = F.date_sub(F.lit(h.as_of), 7)
    return (h.cleaned.where((F.col("event_date") >= lo) & (F.col("event_date") <= F.lit(h.as_of)))
            .select("event_id", "player_id", "event_type_normalized", "event_date"))


# =========================================================================== E: joins
@register("left_join_features")
def left_join_features(h: Lakehouse):
    """Churn features via three aggregates and two left joins on player_id."""
    return gold.churn_features_joined(h.cleaned, h.sessions, h.purchases, h.as_of)


@register("left_join_first_seen")
def left_join_first_seen(h: Lakehouse):
    """ARPU features via purchase aggregates left-joined to first-seen dates."""
    return gold.arpu_features_joined(h.purchases, h.cleaned, h.as_of)


# =========================================================================== F: aggregates
@register("conditional_aggs")
def conditional_aggs(h: Lakehouse):
    """count(*), conditional counts, conditional sums and averages per event date."""
    c = F.col
    t = c("event_type_normalized")
    g = h.cleaned.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(t == "login").alias("logins"),
        F.count_if(t == "kill").alias("kills"),
        F.coalesce(F.sum(F.when(t == "purchase", money("item_price_usd"))), F.lit(0).cast("decimal(18,2)"))
        .cast("double").alias("purchase_revenue"),
        F.sum(F.when(t == "purchase", money("item_price_usd"))).alias("_ps"),
        F.count(F.when(t == "purchase", money("item_price_usd"))).alias("_pn"),
        F.sum(F.when(t == "session_end", c("session_duration_seconds"))).alias("_ss"),
        F.count(F.when(t == "session_end", c("session_duration_seconds"))).alias("_sn"),
    )
    return g.select("event_date", "events", "logins", "kills", "purchase_revenue",
                    exact_div(c("_ps"), c("_pn")).alias("avg_purchase_usd"),
                    exact_div(c("_ss"), c("_sn") * F.lit(60)).alias("avg_session_min"))


@register("basic_aggs")
def basic_aggs(h: Lakehouse):
    """Avg, sum, min/max and exact distinct count per region."""
    c = F.col
    g = h.purchases.groupBy("region").agg(
        F.count(F.lit(1)).alias("purchases"),
        money_sum("item_price_usd").alias("revenue_usd"),
        F.sum(money("item_price_usd")).alias("_s"),
        F.min("item_price_usd").alias("min_price"),
        F.max("item_price_usd").alias("max_price"),
        F.min("event_date").alias("first_purchase_date"),
        F.max("event_date").alias("last_purchase_date"),
        F.count_distinct("player_id").alias("buyers"),
    )
    return g.select("region", "purchases", "revenue_usd",
                    exact_div(c("_s"), c("purchases")).alias("avg_price"),
                    "min_price", "max_price", "first_purchase_date", "last_purchase_date", "buyers")


@register("primary_mode")
def primary_mode(h: Lakehouse):
    """deterministic most-used platform / region / game mode per player."""
    return gold.primary_dimensions(h.cleaned, h.as_of)


@register("whale_p95")
def whale_p95(h: Lakehouse):
    """whale = 90-day spend above the 95th percentile of paying players."""
    arpu = gold.arpu_features(None, h.cleaned, h.as_of, whale_rule="p95", keep_threshold=True)
    return arpu.select("player_id", "total_spend_90d", "whale_threshold", "is_whale")


@register("grouping_levels")
def grouping_levels(h: Lakehouse):
    """global, 1-, 2- and 3-key groupings in one ROLLUP (one Expand, one shuffle)."""
    return (h.cleaned.rollup("region", "platform", "event_type_normalized")
            .agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("events"),
                 F.count_distinct("player_id").alias("players")))


# =========================================================================== J: scalar families
@register("scalar_string")
def scalar_string(h: Lakehouse):
    """J string/hash: upper, lower, trim, concat_ws, sha2, length."""
    c = F.col
    key = F.concat_ws(":", c("player_id"), c("event_type_normalized"), c("platform"))
    return h.cleaned.select(
        "event_id",
        F.upper("player_id").alias("player_upper"),
        F.lower("region").alias("region_lower"),
        F.trim(F.concat(F.lit("  "), c("event_type_normalized"), F.lit(" "))).alias("type_trimmed"),
        key.alias("event_key"),
        F.sha2(key, 256).alias("event_key_sha256"),
        F.length("platform").cast("int").alias("platform_len"),
    )


@register("scalar_datetime")
def scalar_datetime(h: Lakehouse):
    """J date/time: to_date, hour, unix_timestamp, from_unixtime, date_sub, datediff, trunc."""
    c = F.col
    return h.cleaned.select(
        "event_id", "event_date",
        F.hour("event_ts").alias("event_hour"),
        F.unix_timestamp("event_ts").alias("event_unix"),
        F.from_unixtime(F.unix_timestamp("event_ts")).alias("event_second_text"),
        F.date_sub(c("event_date"), 7).alias("week_before"),
        F.datediff(F.lit(h.as_of), c("event_date")).alias("days_to_as_of"),
        F.trunc("event_date", "month").alias("event_month"),
        (F.unix_timestamp("ingest_ts") - F.unix_timestamp("event_ts")).alias("ingest_lag_s"),
    )


@register("scalar_json")
def scalar_json(h: Lakehouse):
    """J JSON: path extraction from raw payload strings (malformed -> NULL)."""
    p = F.col("payload")
    return h.bronze.select(
        "event_id",
        F.get_json_object(p, "$.weapon").alias("weapon"),
        F.get_json_object(p, "$.headshot").try_cast("boolean").alias("headshot"),
        F.get_json_object(p, "$.item_price_usd").try_cast("double").alias("item_price_usd"),
        F.get_json_object(p, "$.total_kills").try_cast("int").alias("total_kills"),
        F.get_json_object(p, "$.reason").alias("reason"),
        F.coalesce(F.get_json_object(p, "$.opponent_id"), F.get_json_object(p, "$.killed_by")).alias("opponent_id"),
    )


@register("scalar_cast")
def scalar_cast(h: Lakehouse):
    """J casts: string -> timestamp/date/bigint/boolean/double, timestamp -> string."""
    c = F.col
    ts = F.try_to_timestamp(c("timestamp"))
    return h.bronze.select(
        "event_id",
        ts.alias("event_ts"),
        c("ingest_date").try_cast("date").alias("ingest_date"),
        c("event_id").try_cast("bigint").alias("event_num"),
        F.get_json_object("payload", "$.headshot").try_cast("boolean").alias("headshot"),
        F.get_json_object("payload", "$.duration_seconds").try_cast("int").alias("duration_seconds"),
        ts.cast("string").alias("event_ts_text"),
    )


@register("scalar_conditional")
def scalar_conditional(h: Lakehouse):
    """J conditionals: coalesce, multi-branch when/otherwise, isNull."""
    c = F.col
    t = c("event_type_normalized")
    p = c("item_price_usd")
    return h.cleaned.select(
        "event_id",
        F.coalesce(c("opponent_id"), c("item_id"), F.lit("none")).alias("counterpart"),
        F.when(t.isin("kill", "death"), "combat").when(t == "purchase", "commerce")
        .when(t.isin("login", "logout"), "presence").otherwise("other").alias("category"),
        F.when(p.isNull(), F.lit(None).cast("string")).when(p >= 20, "high").when(p >= 5, "mid")
        .otherwise("low").alias("price_band"),
        c("game_mode").isNull().alias("mode_missing"),
    )


@register("scalar_math")
def scalar_math(h: Lakehouse):
    """J math: + - * /, pmod, abs and half-up rounding (exact, integer based)."""
    c = F.col
    return h.sessions.select(
        "session_id", "kd_ratio",
        (c("kills") - c("deaths")).alias("net_kills"),
        ((c("kills") + c("deaths")) * 2).alias("double_engagements"),
        F.abs(c("kills") - c("deaths")).alias("abs_net"),
        F.pmod(c("kills"), F.lit(7)).alias("kills_mod7"),
        (c("duration_min") * F.lit(60.0)).alias("duration_s"),
        (c("experience_gain").cast("double") / F.lit(100.0)).alias("xp_hundreds"),
        ratio_round(c("kills"), c("deaths") + F.lit(1), 2).alias("kd_ratio_2dp"),
    )


@register("null_fill")
def null_fill(h: Lakehouse):
    """J fillna: typed defaults for NULL parsed fields."""
    return (h.cleaned.select("event_id", "weapon", "item_price_usd", "session_kills", "payment_method")
            .fillna({"weapon": "none", "item_price_usd": 0.0, "session_kills": 0,
                     "payment_method": "unknown"}))


@register("dedup_events")
def dedup_events(h: Lakehouse):
    """Keyed de-duplication: the surviving (earliest-ingested) copy per event id."""
    d = silver.dedup_events(silver.typed_events(h.bronze))
    return d.select("event_id", "player_id", "event_ts", "ingest_ts")


# =========================================================================== K: gold
@register("arpu_features_daily")
def arpu_features_daily(h: Lakehouse):
    """K2/K3: ARPU features with premium tier and whale flag."""
    return h.arpu


@register("player_segments")
def player_segments(h: Lakehouse):
    """K4: engagement and revenue segments."""
    return h.segments


@register("churn_overview")
def churn_overview(h: Lakehouse):
    """K7: one-row churn overview."""
    return gold.churn_overview(h.churn)


@register("label_balance")
def label_balance(h: Lakehouse):
    """K8: label balance / leakage check."""
    return gold.label_balance(h.churn)


@register("tier_summary")
def tier_summary(h: Lakehouse):
    """K9: premium-tier summary."""
    return gold.tier_summary(h.arpu)


@register("segment_matrix")
def segment_matrix(h: Lakehouse):
    """Engagement x revenue matrix."""
    return gold.segment_matrix(h.segments)


@register("churn_point_in_time")
def churn_point_in_time(h: Lakehouse):
    """K5: leak-free snapshot, features to a week before the last day, label = no login in that week."""
    return gold.churn_point_in_time(h.cleaned, None, None, h.as_of - dt.timedelta(days=7), 7)


# =========================================================================== L / M: scoring, BI
SCORE_NO_CLOCK = ["player_id", "compute_date", "churn_probability", "risk_tier", "days_since_login",
                  "login_count_7d", "total_spend_30d", "platform_primary", "region_primary"]


@register("ml_features")
def ml_features(h: Lakehouse):
    """L1: model input columns with NULL fills."""
    return ml.prepare_features(h.churn)


@register("ml_split")
def ml_split(h: Lakehouse):
    """L2: deterministic 70/30 hash split flag per player."""
    return ml.prepare_features(h.churn).select("player_id", "churn_label",
                                               ml.split_flag().alias("is_train"))


@register("risk_tier")
def risk_tier(h: Lakehouse):
    """L9 tiering over the deterministic stand-in probability (scored_at omitted: wall clock)."""
    return h.scores.select(*SCORE_NO_CLOCK)


@register("risk_summary")
def risk_summary(h: Lakehouse):
    """Players, mean probability and spend per risk tier."""
    return bi.risk_summary(h.scores)


@register("vw_retention_churn")
def vw_retention_churn(h: Lakehouse):
    """M1."""
    return bi.vw_retention_churn(h.scores)


@register("vw_player_segments")
def vw_player_segments(h: Lakehouse):
    """M2."""
    return bi.vw_player_segments(h.segments)


@register("vw_arpu_summary")
def vw_arpu_summary(h: Lakehouse):
    """M3."""
    return bi.vw_arpu_summary(h.arpu)


@register("bi_measures")
def bi_measures(h: Lakehouse):
    """M4: dashboard measures."""
    return bi.bi_measures(bi.vw_retention_churn(h.scores), bi.vw_arpu_summary(h.arpu))


@register("action_list")
def action_list(h: Lakehouse):
    """M5/H3: top-20 high-risk players by 30-day spend."""
    return bi.action_list(h.scores, 20)


# =========================================================================== K6 / D6 / C3 / N
from respawn.operators import metrics  # noqa: E402


@register("churn_history")
def churn_history(h: Lakehouse):
    """K6: churn features for every day of the events (one row per player per day),
    written as a gold table partitioned by compute date."""
    return h.history()


@register("latest_snapshot")
def latest_snapshot(h: Lakehouse):
    """Rows of the latest compute date of the history table (scalar-subquery
    partition filter: only the newest partition is read)."""
    return bi.latest_snapshot(h.history())


@register("login_sessions")
def login_sessions(h: Lakehouse):
    """Documented login -> logout sessions with in-session activity."""
    return silver.sessions_from_login_logout(h.cleaned)


@register("dau")
def dau(h: Lakehouse):
    """Daily active players."""
    return metrics.daily_active(h.cleaned)


@register("rolling_active")
def rolling_active(h: Lakehouse):
    """Trailing 7/30-day distinct active players and 7-day mean DAU."""
    return metrics.rolling_active(h.cleaned)


@register("retention_curve")
def retention_curve(h: Lakehouse):
    """Retention by first-seen cohort and day offset (censored past the data end)."""
    return metrics.retention_curve(h.cleaned)


@register("arpu_by_region")
def arpu_by_region(h: Lakehouse):
    """ARPU / ARPPU by region."""
    return metrics.arpu_by_region(h.cleaned)


@register("spend_distribution")
def spend_distribution(h: Lakehouse):
    """Spend buckets (free / low / mid / whale) over 30-day spend."""
    return metrics.spend_distribution(h.churn)


@register("ltv_by_cohort")
def ltv_by_cohort(h: Lakehouse):
    """Revenue per player by first-seen month, players who never pay included."""
    return metrics.ltv_by_cohort(h.cleaned)


@register("spend_percentiles")
def spend_percentiles(h: Lakehouse):
    """Exact percentiles of the 30-day spend."""
    return metrics.spend_percentiles(h.churn)


@register("session_count_dist")
def session_count_dist(h: Lakehouse):
    """Session count distribution with mean session length."""
    return metrics.session_count_distribution(h.sessions)


@register("platform_region")
def platform_region(h: Lakehouse):
    """Platform x region breakdown."""
    return metrics.platform_region(h.cleaned)


@register("win_rate_by_tier")
def win_rate_by_tier(h: Lakehouse):
    """Win rate by K/D quartile tier."""
    return metrics.win_rate_by_tier(h.sessions)


# =========================================================================== A / O: tables, streams
from pyspark.ml.functions import array_to_vector  # noqa: E402

from respawn.constants import RAW_COLUMNS  # noqa: E402
from respawn.plans import incremental, layers  # noqa: E402
from respawn.sources import files, generate  # noqa: E402
from respawn.streaming import silver_stream  # noqa: E402


@register("gen_summary")
def gen_summary(h: Lakehouse):
    """Summary of the raw events (rows, players, per-type/region/platform/day counts)."""
    return generate.generation_summary(h.raw)


@register("csv_round_trip")
def csv_round_trip(h: Lakehouse):
    """The raw events exported as CSV files and read with the fixed schema."""
    return files.read_raw_csv(h.spark, h.landing())


@register("stream_bronze")
def stream_bronze(h: Lakehouse):
    """CSV files ingested by the triggered stream, bronze table read back."""
    return h.spark.read.schema(files.RAW_SCHEMA).parquet(h.lake("bronze", "raw_events")).select(*RAW_COLUMNS)


#: What the copies of one event share; which copy a stream sees first isn't fixed.
STREAMED = [c for c in CLEANED_COLUMNS if c not in ("ingest_ts", "ingest_date")]


@register("stream_clean_events")
def stream_clean_events(h: Lakehouse):
    """A4/O2/O3: C1 on a stream over the bronze files, silver table read back."""
    root = h.lake("streamed")
    bronze = silver_stream.bronze_file_stream(h.spark, h.lake("bronze", "raw_events"), files.RAW_SCHEMA)
    if not files.path_exists(h.spark, f"{root}/events"):
        silver_stream.run_available(silver_stream.clean_events_stream(bronze), f"{root}/events", f"{root}/checkpoint")
    return h.spark.read.parquet(f"{root}/events").select(*STREAMED)


@register("stream_merged_events")
def stream_merged_events(h: Lakehouse):
    """Bronze streamed into the cleaned table by exact merges, all columns compared."""
    root = h.lake("merged")
    if not files.path_exists(h.spark, f"{root}/events"):
        bronze = silver_stream.bronze_file_stream(h.spark, h.lake("bronze", "raw_events"), files.RAW_SCHEMA)
        incremental.merge_stream(h.spark, bronze, f"{root}/events", f"{root}/checkpoint", f"{root}/staging")
    return h.spark.read.parquet(f"{root}/events").select(*CLEANED_COLUMNS)


@register("ingest_quality")
def ingest_quality(h: Lakehouse):
    """O1/B4 on streams: rule counts of the ingest, summed over its micro-batches."""
    counts = files.read_quality(h.spark, h.lake("bronze", "raw_events_quality"))
    return counts.groupBy("rule").agg(F.sum("total").alias("total"), F.sum("failed").alias("failed"))


@register("expect_or_fail")
def expect_or_fail(h: Lakehouse):
    """Bronze rows pass the same rules as fail rules; the job stops if one doesn't."""
    rules = [dq.Rule(r.name, r.predicate, dq.FAIL) for r in dq.RAW_RULES]
    return dq.expect(h.bronze, rules).groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@register("catalog_tables")
def catalog_tables(h: Lakehouse):
    """Layer jobs write partitioned tables twice, the catalog names them, read by name."""
    root = h.lake()
    for _ in range(2):  # the second run replaces the first
        layers.build_silver(h.spark, root)
    layers.register_catalog(h.spark, root)
    return h.spark.table("silver.player_purchase_events").select(*silver.PURCHASE_COLUMNS)


@register("preview")
def preview(h: Lakehouse):
    """H2: the first 50 kill events (a preview is a limit by definition)."""
    return profile.preview(silver.kill_events(h.cleaned), 50, ["event_ts", "event_id"])


@register("ml_vectors")
def ml_vectors(h: Lakehouse):
    """L3/L4: label indexes and the assembled feature vector, one column a slot."""
    return ml.assembled(h.churn)


@register("score_quality")
def score_quality(h: Lakehouse):
    """Confusion counts, accuracy and F1 of the stand-in score at 0.5, and its AUC over all scores."""
    p = bi.standin_probability()
    return ml.confusion(h.churn.select("churn_label", (p >= 0.5).cast("double").alias("prediction"), p.alias("churn_probability")))


@register("prediction_review")
def prediction_review(h: Lakehouse):
    """Label, prediction and probability of each player side by side (the stand-in as a model's output vector)."""
    p = bi.standin_probability()
    scored = h.churn.select("player_id", ml.LABEL, (p >= 0.5).cast("double").alias("prediction"), array_to_vector(F.array(1 - p, p)).alias("probability"))
    return ml.prediction_review(scored)


@register("declared_view")
def declared_view(h: Lakehouse):
    """Purchases as a named view that isn't stored, queried by its name."""
    files.declare_view(h.purchases, "respawn_purchases")
    return h.spark.sql("SELECT region, count(*) AS purchases FROM respawn_purchases WHERE item_price_usd >= 10 GROUP BY region")
