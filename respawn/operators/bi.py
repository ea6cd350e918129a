"""Scoring tiers, BI views and measures.

All views are ``groupBy`` aggregates over player-level gold tables: map-side
partial aggregation, one small shuffle. Means are exact (integer / decimal
sums divided once) and rounded half-up with integer arithmetic where the view
rounds, so results are independent of partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respawn.constants import RISK_HIGH, RISK_MEDIUM
from respawn.functions.exact import exact_div, money, ratio_round, units

SCORE_COLUMNS = [
    "player_id", "compute_date", "scored_at", "churn_probability", "risk_tier",
    "days_since_login", "login_count_7d", "total_spend_30d", "platform_primary", "region_primary",
]


def risk_tier(p: Column | str = "churn_probability") -> Column:
    """>= 0.75 high, >= 0.40 medium, else low; NULL / NaN probability -> NULL tier."""
    p = F.col(p) if isinstance(p, str) else p
    return (F.when(p.isNull() | F.isnan(p), F.lit(None).cast("string"))
            .when(p >= F.lit(RISK_HIGH), "high")
            .when(p >= F.lit(RISK_MEDIUM), "medium")
            .otherwise("low"))


def standin_probability() -> Column:
    """Deterministic stand-in for a model probability (value-checkable).

    (d + 1) / (d + 1 + logins_7d) with d = days since login (30 if never):
    grows with recency gap, shrinks with recent logins. Used only where a
    trained model's output would not be SQL-reproducible.
    """
    d = F.coalesce(F.col("days_since_login"), F.lit(30)).cast("long") + F.lit(1)
    return exact_div(d, d + F.col("login_count_7d").cast("long"))


def latest_snapshot(features: DataFrame, date_col: str = "compute_date") -> DataFrame:
    """Rows of the most recent snapshot. The max date is a scalar
    subquery evaluated inside the job (no driver round trip); on a table
    partitioned by ``compute_date`` it becomes a partition filter."""
    latest = features.agg(F.max(date_col)).scalar()
    return features.where(F.col(date_col) == latest)


def score_with_standin(features: DataFrame, scored_at: Column | None = None) -> DataFrame:
    scored = features.select(
        "player_id", "compute_date",
        (scored_at if scored_at is not None else F.current_timestamp()).alias("scored_at"),
        standin_probability().alias("churn_probability"),
        "days_since_login", "login_count_7d", "total_spend_30d", "platform_primary", "region_primary",
    ).withColumn("risk_tier", risk_tier())
    return scored.select(*SCORE_COLUMNS)


def risk_summary(scores: DataFrame) -> DataFrame:
    """Players, mean probability (4 dp) and mean 30-day spend per tier."""
    agg = scores.groupBy("risk_tier").agg(
        F.count(F.lit(1)).alias("players"),
        F.sum(units("churn_probability", 1_000_000)).alias("_p"),
        F.count("churn_probability").alias("_np"),
        F.sum(money("total_spend_30d")).alias("_s"),
    )
    return agg.select(
        "risk_tier", "players",
        ratio_round(F.col("_p"), F.col("_np") * F.lit(1_000_000), 4).alias("avg_churn_probability"),
        ratio_round((F.col("_s") * 100).cast("long"), F.col("players") * F.lit(100), 2).alias("avg_spend_30d"),
    ).orderBy("risk_tier")


# --------------------------------------------------------------------------- M1-M3
def vw_retention_churn(scores: DataFrame) -> DataFrame:
    """M1: players and means by date, region, platform, risk tier."""
    agg = scores.groupBy(
        "compute_date", F.col("region_primary").alias("region"),
        F.col("platform_primary").alias("platform"), "risk_tier",
    ).agg(
        F.count(F.lit(1)).alias("players"),
        F.sum(units("churn_probability", 1_000_000)).alias("_p"),
        F.count("churn_probability").alias("_np"),
        F.sum("days_since_login").alias("_d"),
        F.count("days_since_login").alias("_nd"),
        F.sum(money("total_spend_30d")).alias("_s"),
        F.count("total_spend_30d").alias("_ns"),
    )
    return agg.select(
        "compute_date", "region", "platform", "risk_tier", "players",
        ratio_round(F.col("_p"), F.col("_np") * F.lit(1_000_000), 6).alias("avg_churn_probability"),
        exact_div(F.col("_d"), F.col("_nd")).alias("avg_days_since_login"),
        exact_div(F.col("_s"), F.col("_ns")).alias("avg_spend_30d"),
    )


def vw_player_segments(segments: DataFrame) -> DataFrame:
    """M2: players and means by date, region, platform and both segments."""
    agg = segments.groupBy(
        "compute_date", F.col("region_primary").alias("region"),
        F.col("platform_primary").alias("platform"), "engagement_segment", "revenue_segment",
    ).agg(
        F.count(F.lit(1)).alias("players"),
        F.sum(units("avg_session_duration_7d", 1_000_000)).alias("_d"),
        F.count("avg_session_duration_7d").alias("_nd"),
        F.sum(units("win_rate_7d", 1_000_000)).alias("_w"),
        F.count("win_rate_7d").alias("_nw"),
    )
    return agg.select(
        "compute_date", "region", "platform", "engagement_segment", "revenue_segment", "players",
        ratio_round(F.col("_d"), F.col("_nd") * F.lit(1_000_000), 6).alias("avg_session_duration_7d"),
        ratio_round(F.col("_w"), F.col("_nw") * F.lit(1_000_000), 6).alias("avg_win_rate_7d"),
    )


def vw_arpu_summary(arpu: DataFrame) -> DataFrame:
    """M3: paying players and spend by date and premium tier."""
    agg = arpu.groupBy("compute_date", "premium_tier").agg(
        F.count(F.lit(1)).alias("paying_players"),
        F.sum(units("avg_spend_7d", 1_000_000)).alias("_a7"),
        F.sum(units("avg_spend_30d", 1_000_000)).alias("_a30"),
        F.sum(money("total_spend_90d")).alias("_s90"),
        F.sum("purchase_frequency_30d").alias("_f30"),
    )
    n = F.col("paying_players")
    return agg.select(
        "compute_date", "premium_tier", "paying_players",
        ratio_round(F.col("_a7"), n * F.lit(1_000_000), 6).alias("avg_spend_7d"),
        ratio_round(F.col("_a30"), n * F.lit(1_000_000), 6).alias("avg_spend_30d"),
        F.col("_s90").cast("double").alias("total_spend_90d"),
        exact_div(F.col("_f30"), n).alias("avg_purchase_frequency_30d"),
    )


def _sql_round6(num: str, den: str) -> str:
    """SQL of ``ratio_round(num, den, 6)``: whole numbers only."""
    n, d = f"CAST({num} AS DECIMAL(38,0))", f"NULLIF(CAST({den} AS DECIMAL(19,0)), 0)"
    rest = f"CAST({n} % {d} AS DECIMAL(19,0))"
    return f"(CAST({n} div {d} AS DECIMAL(28,0)) * 1000000 + ({rest} * 2000000 + {d}) div ({d} * 2)) / 1000000D"


def _sql_div(num: str, den: str) -> str:
    return f"CASE WHEN {den} <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) END"


def _micros(c: str) -> str:
    return f"sum(CAST(floor({c} * 1000000D + 0.5D) AS BIGINT))"


def _cents(c: str) -> str:
    return f"sum(try_cast({c} AS DECIMAL(18,2)))"


#: M1-M3 as SQL for persistent views: name -> (gold table, select list and grouping).
VIEW_SQL = {
    "vw_retention_churn": ("player_churn_scores", f"""
        compute_date, region_primary AS region, platform_primary AS platform, risk_tier, count(*) AS players,
        {_sql_round6(_micros('churn_probability'), 'count(churn_probability) * 1000000')} AS avg_churn_probability,
        {_sql_div('sum(days_since_login)', 'count(days_since_login)')} AS avg_days_since_login,
        {_sql_div(_cents('total_spend_30d'), 'count(total_spend_30d)')} AS avg_spend_30d""",
                           "compute_date, region_primary, platform_primary, risk_tier"),
    "vw_player_segments": ("player_segments", f"""
        compute_date, region_primary AS region, platform_primary AS platform, engagement_segment, revenue_segment, count(*) AS players,
        {_sql_round6(_micros('avg_session_duration_7d'), 'count(avg_session_duration_7d) * 1000000')} AS avg_session_duration_7d,
        {_sql_round6(_micros('win_rate_7d'), 'count(win_rate_7d) * 1000000')} AS avg_win_rate_7d""",
                           "compute_date, region_primary, platform_primary, engagement_segment, revenue_segment"),
    "vw_arpu_summary": ("arpu_features_daily", f"""
        compute_date, premium_tier, count(*) AS paying_players,
        {_sql_round6(_micros('avg_spend_7d'), 'count(*) * 1000000')} AS avg_spend_7d,
        {_sql_round6(_micros('avg_spend_30d'), 'count(*) * 1000000')} AS avg_spend_30d,
        CAST({_cents('total_spend_90d')} AS DOUBLE) AS total_spend_90d,
        {_sql_div('sum(purchase_frequency_30d)', 'count(*)')} AS avg_purchase_frequency_30d""",
                        "compute_date, premium_tier"),
}


def view_sql(name: str, path: str) -> str:
    """The query of a dashboard view over the gold table's files; it lists them whenever it runs, so it never goes stale."""
    _, select, keys = VIEW_SQL[name]
    return f"SELECT {select} FROM parquet.`{path}` GROUP BY {keys}"


# --------------------------------------------------------------------------- M4 / M5
def bi_measures(retention_view: DataFrame, arpu_view: DataFrame) -> DataFrame:
    """M4: the dashboard measures as one row.

    players, unweighted mean of the view's average probability (as the BI
    measure does), the player-weighted mean, high-risk players and share, and
    ARPU-30d as the mean of the ARPU view's ``avg_spend_30d``.
    """
    r = retention_view.agg(
        F.sum("players").alias("players"),
        F.sum(units("avg_churn_probability", 1_000_000)).alias("_pv"),
        F.count("avg_churn_probability").alias("_npv"),
        F.sum(F.col("players") * units("avg_churn_probability", 1_000_000)).alias("_pw"),
        F.sum(F.when(F.col("avg_churn_probability").isNotNull(), F.col("players"))).alias("_npw"),
        F.sum(F.when(F.col("risk_tier") == "high", F.col("players")).otherwise(0)).alias("high_risk_players"),
        F.lit(None).cast("long").alias("_a"), F.lit(None).cast("long").alias("_na"),
    )
    a = arpu_view.agg(
        *[F.lit(None).cast("long").alias(c) for c in
          ("players", "_pv", "_npv", "_pw", "_npw", "high_risk_players")],
        F.sum(units("avg_spend_30d", 1_000_000)).alias("_a"),
        F.count("avg_spend_30d").alias("_na"),
    )
    # Two one-row aggregates combined by union + max (no join of any kind).
    both = r.unionByName(a).agg(*[F.max(c).alias(c) for c in r.columns])
    return both.select(
        F.col("players").cast("long").alias("players"),
        ratio_round(F.col("_pv"), F.col("_npv") * F.lit(1_000_000), 4).alias("avg_churn_probability"),
        ratio_round(F.col("_pw"), F.col("_npw") * F.lit(1_000_000), 4).alias("weighted_churn_probability"),
        F.col("high_risk_players").cast("long").alias("high_risk_players"),
        ratio_round(F.col("high_risk_players"), F.col("players"), 4).alias("high_risk_share"),
        ratio_round(F.col("_a"), F.col("_na") * F.lit(1_000_000), 4).alias("arpu_30d"),
    )


def action_list(scores: DataFrame, k: int = 20) -> DataFrame:
    """M5/H3: top-k high-risk players by 30-day spend (ties by player id).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: each task keeps
    its own top k, only k rows per task reach the final merge.
    """
    return (scores.where(F.col("risk_tier") == "high")
            .select("player_id", "compute_date", "churn_probability", "days_since_login",
                    "login_count_7d", "total_spend_30d", "platform_primary", "region_primary")
            .orderBy(F.desc("total_spend_30d"), F.asc("player_id"))
            .limit(k))

