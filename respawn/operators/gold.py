"""Gold feature tables: churn features, ARPU features, segments, summaries.

Design: the reference computes three per-player aggregates (events, sessions,
purchases) and left-joins them. Here every event row carries what it counts as
(event, session, purchase; separate tables are unioned to the same shape), and a
*single* ``groupBy`` reduces them: one scan, one hash shuffle of map-side partial
aggregates, no join, no sort. A hot player is
harmless because partial aggregation collapses its rows before the shuffle.
The left-join semantics are kept by requiring at least one activity row.

Every time window is bounded on both sides by the ``as_of`` literal, which
Catalyst folds into constants.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respawn.constants import (CHURN_DAYS, ENGAGEMENT_CORE_LOGINS, ENGAGEMENT_LAPSED_DAYS,
                               ENGAGEMENT_REGULAR_LOGINS, NEW_PLAYER_DAYS, PREMIUM_TIER_ELSE,
                               PREMIUM_TIERS, REVENUE_SPENDER_30D, REVENUE_WHALE_30D,
                               WHALE_SPEND_90D)
from respawn.functions.exact import MONEY, exact_div, money, ratio_round, units
from respawn.functions.quantiles import exact_quantiles
from respawn.operators import dq
from respawn.operators.silver import duration_seconds, session_values

CHURN_COLUMNS = [
    "player_id", "compute_date", "first_seen_date", "last_login_date", "login_count_7d",
    "login_count_30d", "kill_count_7d", "event_count_7d", "platform_primary", "region_primary",
    "match_count_7d", "avg_session_duration_7d", "total_playtime_7d", "win_rate_7d",
    "avg_spend_7d", "avg_spend_30d", "total_spend_30d", "days_since_login", "is_new_player",
    "churn_label",
]

ARPU_COLUMNS = [
    "player_id", "compute_date", "avg_spend_7d", "avg_spend_30d", "total_spend_90d",
    "avg_spend_all_time", "purchase_frequency_7d", "purchase_frequency_30d",
    "first_purchase_date", "last_purchase_date", "first_seen_date",
    "days_since_first_purchase", "days_since_last_purchase", "premium_tier", "is_whale",
]

SEGMENT_COLUMNS = [
    "player_id", "compute_date", "region_primary", "platform_primary", "days_since_login",
    "login_count_7d", "total_spend_30d", "avg_session_duration_7d", "win_rate_7d",
    "engagement_segment", "revenue_segment",
]


def as_date(d) -> dt.date:
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def _rows(df: DataFrame, kind: str, **columns: Column) -> DataFrame:
    """One row shape for all silver inputs; ``kind`` marks what a row counts as."""
    empty = {"t": "string", "platform": "string", "region": "string", "secs": "long", "won": "long", "price": MONEY}
    return df.select("player_id", columns["d"].alias("d"),
                     *[F.lit(k == kind).alias(k) for k in ("ev", "se", "pu")],
                     *[columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in empty.items()])


def _unified(events: DataFrame | None, sessions: DataFrame | None, purchases: DataFrame | None) -> DataFrame:
    """Project separate silver tables onto one row shape for a single reduction."""
    parts = []
    if events is not None:
        parts.append(_rows(events, "ev", d=F.col("event_date"), t=F.col("event_type_normalized"),
                           platform=F.col("platform"), region=F.col("region")))
    if sessions is not None:
        parts.append(_rows(sessions, "se", d=F.col("session_date"), secs=duration_seconds("duration_min"),
                           won=F.col("matches_won")))
    if purchases is not None:
        parts.append(_rows(purchases, "pu", d=F.col("event_date"), price=money("item_price_usd")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _unified_events(events: DataFrame) -> DataFrame:
    """The same rows from the cleaned events alone: sessions and purchases are filters of them,
    so one scan carries all three inputs and an event row counts as what it is."""
    kind = F.col("event_type_normalized")
    session = session_values()
    rows = events.select(
        "player_id", F.col("event_date").alias("d"), F.lit(True).alias("ev"),
        F.coalesce((kind == "session_end") & (session["duration_min"] > 0), F.lit(False)).alias("se"),
        F.coalesce((kind == "purchase") & F.expr(dq.VALID_PRICE), F.lit(False)).alias("pu"),
        kind.alias("t"), "platform", "region",
        duration_seconds(session["duration_min"]).alias("secs"), session["matches_won"].cast("long").alias("won"),
        money("item_price_usd").alias("price"))
    return rows


def _window(days: int, as_of: dt.date) -> Column:
    """event date within [as_of - days, as_of] (inclusive both ends)."""
    return (F.col("d") >= F.lit(as_of - dt.timedelta(days=days))) & (F.col("d") <= F.lit(as_of))


def churn_aggregates(unified: DataFrame, as_of: dt.date, horizon_days: int | None = None) -> DataFrame:
    """Per-player reduction behind K1 (and K5 when ``horizon_days`` is given)."""
    t, ev, se, pu = F.col("t"), F.col("ev"), F.col("se"), F.col("pu")
    upto = F.col("d") <= F.lit(as_of)
    w7, w30 = _window(7, as_of), _window(30, as_of)
    login = t == "login"
    aggs = [
        F.count_if(ev & (upto | F.col("d").isNull())).alias("_n_events"),
        F.min(F.when(ev & upto, F.col("d"))).alias("first_seen_date"),
        F.max(F.when(ev & login & upto, F.col("d"))).alias("last_login_date"),
        F.count_if(ev & login & w7).alias("login_count_7d"),
        F.count_if(ev & login & w30).alias("login_count_30d"),
        F.count_if(ev & (t == "kill") & w7).alias("kill_count_7d"),
        F.count_if(ev & w7).alias("event_count_7d"),
        F.mode(F.when(ev & (upto | F.col("d").isNull()), F.col("platform")), True).alias("platform_primary"),
        F.mode(F.when(ev & (upto | F.col("d").isNull()), F.col("region")), True).alias("region_primary"),
        F.count_if(se & w7).alias("match_count_7d"),
        F.count(F.when(se & w7, F.col("secs"))).alias("_n_dur7"),
        F.sum(F.when(se & w7, F.col("secs"))).alias("_sec7"),
        F.count(F.when(se & w7, F.col("won"))).alias("_n_won7"),
        F.sum(F.when(se & w7, F.col("won"))).alias("_won7"),
        F.sum(F.when(pu & _window(7, as_of), F.col("price"))).alias("_spend7"),
        F.sum(F.when(pu & w30, F.col("price"))).alias("_spend30"),
    ]
    if horizon_days is not None:
        end = as_of + dt.timedelta(days=horizon_days)
        future = (F.col("d") > F.lit(as_of)) & (F.col("d") <= F.lit(end))
        aggs.append(F.count_if(ev & login & future).alias("_future_logins"))
    return unified.groupBy("player_id").agg(*aggs).where(F.col("_n_events") > 0)


def _finish_churn(agg: DataFrame, as_of: dt.date, churn_days: int, never_login: str) -> DataFrame:
    zero_m = F.lit(0).cast(MONEY)
    spend7 = F.coalesce(F.col("_spend7"), zero_m).cast("double")
    spend30 = F.coalesce(F.col("_spend30"), zero_m).cast("double")
    days_since = F.datediff(F.lit(as_of), F.col("last_login_date"))
    if never_login == "churned":
        label = F.when(days_since.isNull() | (days_since >= churn_days), 1).otherwise(0)
    else:
        label = F.when(days_since >= churn_days, 1).otherwise(0)
    out = agg.select(
        "player_id",
        F.lit(as_of).alias("compute_date"),
        "first_seen_date", "last_login_date",
        "login_count_7d", "login_count_30d", "kill_count_7d", "event_count_7d",
        "platform_primary", "region_primary", "match_count_7d",
        F.coalesce(exact_div(F.col("_sec7"), F.col("_n_dur7") * F.lit(60)), F.lit(0.0)).alias("avg_session_duration_7d"),
        (F.coalesce(F.col("_sec7"), F.lit(0)).cast("double") / F.lit(3600.0)).alias("total_playtime_7d"),
        F.coalesce(exact_div(F.col("_won7"), F.col("_n_won7")), F.lit(0.0)).alias("win_rate_7d"),
        (spend7 / F.lit(7.0)).alias("avg_spend_7d"),
        (spend30 / F.lit(30.0)).alias("avg_spend_30d"),
        spend30.alias("total_spend_30d"),
        days_since.alias("days_since_login"),
        (F.datediff(F.lit(as_of), F.col("first_seen_date")) < NEW_PLAYER_DAYS).alias("is_new_player"),
        label.cast("int").alias("churn_label"),
        *([F.col("_future_logins")] if "_future_logins" in agg.columns else []),
    )
    if never_login == "exclude":
        out = out.where(F.col("last_login_date").isNotNull())
    return out


def all_activity(events: DataFrame, sessions: DataFrame | None, purchases: DataFrame | None) -> DataFrame:
    """Rows for the reductions: from the tables given, or from the events alone where both
    derived tables are None (one scan instead of three)."""
    return _unified_events(events) if sessions is None and purchases is None else _unified(events, sessions, purchases)


def churn_candidates(events: DataFrame, sessions: DataFrame | None, purchases: DataFrame | None, as_of,
                     churn_days: int = CHURN_DAYS, never_login: str = "retained") -> DataFrame:
    """K1 before its expectations (what the rule counts are taken on)."""
    as_of = as_date(as_of)
    agg = churn_aggregates(all_activity(events, sessions, purchases), as_of)
    return _finish_churn(agg, as_of, churn_days, never_login).select(*CHURN_COLUMNS)


def churn_features(events: DataFrame, sessions: DataFrame | None, purchases: DataFrame | None, as_of,
                   churn_days: int = CHURN_DAYS, never_login: str = "retained",
                   observation=None) -> DataFrame:
    """K1: one row per player as of ``as_of`` (20 columns, see CHURN_COLUMNS).

    ``sessions`` and ``purchases`` may both be None: they are then read off the events.

    ``never_login``: what the label says for a player with no login ever --
    ``'retained'`` (label 0, the reference behaviour), ``'churned'`` or
    ``'exclude'`` (drop the player).
    """
    out = churn_candidates(events, sessions, purchases, as_of, churn_days, never_login)
    return dq.expect(out, dq.CHURN_RULES, observation)


def churn_point_in_time(events: DataFrame, sessions: DataFrame | None, purchases: DataFrame | None,
                        feature_window_end, horizon_days: int = CHURN_DAYS) -> DataFrame:
    """K5: leak-free snapshot. Features use only data up to ``feature_window_end``;
    the label is 1 when the player does not log in during the next
    ``horizon_days`` days. A cut-off whose horizon passes the last event date
    raises (checked inside the job via a scalar subquery, no driver round trip).
    """
    fe = as_date(feature_window_end)
    end = fe + dt.timedelta(days=horizon_days)
    agg = churn_aggregates(all_activity(events, sessions, purchases), fe, horizon_days)
    base = _finish_churn(agg, fe, CHURN_DAYS, "retained")
    data_end = events.agg(F.max("event_date")).scalar()
    label = F.when(data_end < F.lit(end),
                   F.raise_error(F.lit(f"label horizon {end} passes the last event date"))) \
        .otherwise(F.when(F.col("_future_logins") > 0, 0).otherwise(1)).cast("int")
    cols = [c for c in CHURN_COLUMNS if c != "churn_label"]
    return base.select(*cols, F.lit(end).alias("label_window_end"), label.alias("churn_label"))


# --------------------------------------------------------------------------- K2 / K3
def premium_tier(total_spend_90d: Column) -> Column:
    expr = None
    for name, bound, op in PREMIUM_TIERS:
        cond = total_spend_90d >= bound if op == ">=" else total_spend_90d > bound
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(PREMIUM_TIER_ELSE))


def arpu_candidates(purchases: DataFrame | None, events: DataFrame, as_of, whale_rule: str = "threshold",
                    keep_threshold: bool = False) -> DataFrame:
    """K2 before its expectations."""
    as_of = as_date(as_of)
    u = _unified_events(events) if purchases is None else _unified(events, None, purchases)
    pu, ev = F.col("pu"), F.col("ev")
    upto = F.col("d") <= F.lit(as_of)
    agg = u.groupBy("player_id").agg(
        *_arpu_aggs(pu, as_of),
        F.min(F.when(ev & upto, F.col("d"))).alias("first_seen_date"),
    ).where(F.col("_n_purchases") > 0)
    return _arpu_finish(agg, as_of, whale_rule, keep_threshold)


def arpu_features(purchases: DataFrame | None, events: DataFrame, as_of, whale_rule: str = "threshold",
                  observation=None, keep_threshold: bool = False) -> DataFrame:
    """K2: revenue features per paying player (one reduction; ``purchases`` None: read off the events).

    ``whale_rule='threshold'``: 90-day spend >= 250 USD (reference code);
    ``'p95'``: above the 95th percentile of 90-day spend over paying players
    (documented rule; an exact quantile exposed as a scalar subquery).
    """
    out = arpu_candidates(purchases, events, as_of, whale_rule, keep_threshold)
    return dq.expect(out, dq.ARPU_RULES, observation)


def _arpu_aggs(pu: Column, as_of: dt.date) -> list[Column]:
    upto = F.col("d") <= F.lit(as_of)
    return [
        F.count_if(pu & upto).alias("_n_purchases"),
        F.sum(F.when(pu & _window(7, as_of), F.col("price"))).alias("_s7"),
        F.sum(F.when(pu & _window(30, as_of), F.col("price"))).alias("_s30"),
        F.sum(F.when(pu & _window(90, as_of), F.col("price"))).alias("_s90"),
        F.sum(F.when(pu & upto, F.col("price"))).alias("_sall"),
        F.count(F.when(pu & upto, F.col("price"))).alias("_nall"),
        F.count_if(pu & _window(7, as_of)).alias("purchase_frequency_7d"),
        F.count_if(pu & _window(30, as_of)).alias("purchase_frequency_30d"),
        F.min(F.when(pu & upto, F.col("d"))).alias("first_purchase_date"),
        F.max(F.when(pu & upto, F.col("d"))).alias("last_purchase_date"),
    ]


def _arpu_finish(agg: DataFrame, as_of: dt.date, whale_rule: str, keep_threshold: bool = False) -> DataFrame:
    zero = F.lit(0).cast(MONEY)
    s90 = F.coalesce(F.col("_s90"), zero).cast("double")
    out = agg.select(
        "player_id",
        F.lit(as_of).alias("compute_date"),
        (F.coalesce(F.col("_s7"), zero).cast("double") / F.lit(7.0)).alias("avg_spend_7d"),
        (F.coalesce(F.col("_s30"), zero).cast("double") / F.lit(30.0)).alias("avg_spend_30d"),
        s90.alias("total_spend_90d"),
        exact_div(F.col("_sall"), F.col("_nall")).alias("avg_spend_all_time"),
        "purchase_frequency_7d", "purchase_frequency_30d",
        "first_purchase_date", "last_purchase_date", "first_seen_date",
        F.datediff(F.lit(as_of), F.col("first_purchase_date")).alias("days_since_first_purchase"),
        F.datediff(F.lit(as_of), F.col("last_purchase_date")).alias("days_since_last_purchase"),
        premium_tier(s90).alias("premium_tier"),
    )
    if whale_rule == "p95":
        p95 = exact_quantiles(out, "total_spend_90d", [0.95])
        out = out.withColumn("whale_threshold", F.get(p95, F.lit(0)))  # one subquery reference
    else:
        out = out.withColumn("whale_threshold", F.lit(WHALE_SPEND_90D))
    op = (F.col("total_spend_90d") > F.col("whale_threshold")) if whale_rule == "p95" else \
        (F.col("total_spend_90d") >= F.col("whale_threshold"))
    return out.withColumn("is_whale", op).select(*ARPU_COLUMNS, *(["whale_threshold"] if keep_threshold else []))


# --------------------------------------------------------------------------- K4
def engagement_segment() -> Column:
    return (F.when(F.col("days_since_login") >= ENGAGEMENT_LAPSED_DAYS, "lapsed")
            .when(F.col("login_count_7d") >= ENGAGEMENT_CORE_LOGINS, "core")
            .when(F.col("login_count_7d") >= ENGAGEMENT_REGULAR_LOGINS, "regular")
            .otherwise("casual"))


def revenue_segment() -> Column:
    return (F.when(F.col("total_spend_30d") >= REVENUE_WHALE_30D, "whale")
            .when(F.col("total_spend_30d") >= REVENUE_SPENDER_30D, "spender")
            .otherwise("free"))


def player_segments(churn: DataFrame) -> DataFrame:
    """K4: engagement and revenue segment per player (narrow projection)."""
    return churn.select(
        *SEGMENT_COLUMNS[:9],
        engagement_segment().alias("engagement_segment"),
        revenue_segment().alias("revenue_segment"),
    )


# --------------------------------------------------------------------------- K7-K10
def churn_overview(churn: DataFrame) -> DataFrame:
    """K7: one-row overview (2-dp means; churn rate 4 dp), exact arithmetic."""
    n = F.count(F.lit(1))
    one = churn.agg(
        n.alias("players"),
        F.sum("days_since_login").alias("_dsl"), F.count("days_since_login").alias("_ndsl"),
        F.sum("login_count_7d").alias("_logins"),
        F.sum(units("total_playtime_7d", 3600)).alias("_play_s"),
        F.sum(money("total_spend_30d")).alias("_spend"),
        F.sum("churn_label").alias("_churned"),
    )
    return one.select(
        "players",
        ratio_round(F.col("_dsl"), F.col("_ndsl"), 2).alias("avg_days_since_login"),
        ratio_round(F.col("_logins"), F.col("players"), 2).alias("avg_logins_7d"),
        ratio_round(F.col("_play_s"), F.col("players") * F.lit(3600), 2).alias("avg_playtime_hours_7d"),
        ratio_round((F.col("_spend") * 100).cast("long"), F.col("players") * F.lit(100), 2).alias("avg_spend_30d"),
        ratio_round(F.col("_churned"), F.col("players"), 4).alias("churn_rate"),
    )


def label_balance(churn: DataFrame) -> DataFrame:
    """K8: players and feature means per label value (leakage check)."""
    agg = churn.groupBy("churn_label").agg(
        F.count(F.lit(1)).alias("players"),
        F.sum("login_count_7d").alias("_logins"),
        F.sum(units("avg_session_duration_7d", 1_000_000)).alias("_dur"),
        F.sum(money("total_spend_30d")).alias("_spend"),
    )
    return agg.select(
        "churn_label", "players",
        ratio_round(F.col("_logins"), F.col("players"), 2).alias("avg_login_count_7d"),
        ratio_round(F.col("_dur"), F.col("players") * F.lit(1_000_000), 2).alias("avg_session_duration_7d"),
        ratio_round((F.col("_spend") * 100).cast("long"), F.col("players") * F.lit(100), 2).alias("avg_total_spend_30d"),
    ).orderBy("churn_label")


def tier_summary(arpu: DataFrame) -> DataFrame:
    """K9: players, mean 90-day spend and mean 30-day purchases per premium tier."""
    agg = arpu.groupBy("premium_tier").agg(
        F.count(F.lit(1)).alias("players"),
        F.sum(money("total_spend_90d")).alias("_s90"),
        F.sum("purchase_frequency_30d").alias("_f30"),
    )
    return agg.select(
        "premium_tier", "players",
        ratio_round((F.col("_s90") * 100).cast("long"), F.col("players") * F.lit(100), 2).alias("avg_spend_90d"),
        ratio_round(F.col("_f30"), F.col("players"), 2).alias("avg_purchases_30d"),
    ).orderBy(F.desc("avg_spend_90d"), "premium_tier")


def segment_matrix(segments: DataFrame) -> DataFrame:
    """Player count per engagement x revenue segment."""
    return (segments.groupBy("engagement_segment", "revenue_segment")
            .agg(F.count(F.lit(1)).alias("players"))
            .orderBy("engagement_segment", "revenue_segment"))


# --------------------------------------------------------------------------- E1-E3
def churn_features_joined(events: DataFrame, sessions: DataFrame, purchases: DataFrame, as_of) -> DataFrame:
    """K1 written the join way (E1, E2): three per-player aggregates, two left joins.

    Same result as :func:`churn_features`. Each aggregate's output is already
    hash-partitioned by ``player_id``, so the sort-merge joins add no exchange;
    with small session/spend sides AQE turns them into broadcast joins at run
    time (its size check is the runtime statistic, not a guess).
    """
    as_of = as_date(as_of)
    ev = _unified(events, None, None)
    se = _unified(None, sessions, None)
    pu = _unified(None, None, purchases)
    full = churn_aggregates(ev, as_of)
    activity = full.select("player_id", "first_seen_date", "last_login_date", "login_count_7d",
                           "login_count_30d", "kill_count_7d", "event_count_7d",
                           "platform_primary", "region_primary")
    w7, w30 = _window(7, as_of), _window(30, as_of)
    session_f = se.groupBy("player_id").agg(
        F.count_if(w7).alias("match_count_7d"),
        F.count(F.when(w7, F.col("secs"))).alias("_n_dur7"),
        F.sum(F.when(w7, F.col("secs"))).alias("_sec7"),
        F.count(F.when(w7, F.col("won"))).alias("_n_won7"),
        F.sum(F.when(w7, F.col("won"))).alias("_won7"),
    )
    spend_f = pu.groupBy("player_id").agg(
        F.sum(F.when(w7, F.col("price"))).alias("_spend7"),
        F.sum(F.when(w30, F.col("price"))).alias("_spend30"),
    )
    joined = (activity.join(session_f, "player_id", "left")
              .join(spend_f, "player_id", "left")
              .fillna({"match_count_7d": 0}))
    return _finish_churn(joined, as_of, CHURN_DAYS, "retained").select(*CHURN_COLUMNS)


def arpu_features_joined(purchases: DataFrame, events: DataFrame, as_of) -> DataFrame:
    """K2 written the join way (E3): purchase aggregates left-joined to first-seen dates."""
    as_of = as_date(as_of)
    pu = purchases.select("player_id", F.col("event_date").alias("d"),
                          money("item_price_usd").alias("price"))
    agg = pu.groupBy("player_id").agg(*_arpu_aggs(F.lit(True), as_of)).where(F.col("_n_purchases") > 0)
    first_seen = events.groupBy("player_id").agg(
        F.min(F.when(F.col("event_date") <= F.lit(as_of), F.col("event_date"))).alias("first_seen_date"))
    return dq.expect(_arpu_finish(agg.join(first_seen, "player_id", "left"), as_of, "threshold"), dq.ARPU_RULES)


# --------------------------------------------------------------------------- F9
def primary_dimensions(events: DataFrame, as_of=None) -> DataFrame:
    """most frequent platform, region and game mode per player (ties -> smallest).

    ``mode(col, deterministic=True)`` keeps a small value->count map per group
    (a handful of values per player) and merges maps map-side.
    """
    df = events if as_of is None else events.where(
        (F.col("event_date") <= F.lit(as_date(as_of))) | F.col("event_date").isNull())
    return df.groupBy("player_id").agg(
        F.mode("platform", True).alias("platform_primary"),
        F.mode("region", True).alias("region_primary"),
        F.mode("game_mode", True).alias("game_mode_primary"),
    )


# --------------------------------------------------------------------------- K6
def churn_history(events: DataFrame, sessions: DataFrame | None, purchases: DataFrame | None, start, end) -> DataFrame:
    """K6: K1 features for every compute date in [start, end] (one row per player per day).

    The events are first reduced to one row per (player, day, platform, region) with additive
    measures (map-side partial aggregation; days before every window fold into one), so a hot player's events meet
    no single task. The daily rows then move once, by player; nothing is shuffled or joined after that. There each
    player gets a row for each compute date, and windows ordered by day sum what lies behind it: the last 7 and
    30 days, or all of it. Platform and region modes are running minima: of all (count so far, value) pairs up to a
    day, counts only grow, so the greatest count (ties: smallest value) is the mode at that day.
    Cost is O(daily rows + result rows). Write the result partitioned by ``compute_date``.
    """
    start, end = as_date(start), as_date(end)
    if end < start:
        raise ValueError("end before start")
    horizon = start - dt.timedelta(days=31)  # the day that stands for all before any window
    u = all_activity(events, sessions, purchases)
    d, t, ev, se, pu = (F.col(c) for c in ("d", "t", "ev", "se", "pu"))
    u = u.where(d.isNull() | (d <= F.lit(end))).withColumn("day", F.greatest(d, F.when(d.isNotNull(), F.lit(horizon))))
    daily = u.groupBy("player_id", "day", "platform", "region").agg(
        F.count_if(ev).alias("n_ev"),
        F.count_if(ev & (t == "login")).alias("n_login"),
        F.count_if(ev & (t == "kill")).alias("n_kill"),
        F.count_if(se).alias("n_ses"),
        F.count(F.when(se, F.col("secs"))).alias("n_dur"),
        F.sum(F.when(se, F.col("secs"))).alias("secs"),
        F.count(F.when(se, F.col("won"))).alias("n_won"),
        F.sum(F.when(se, F.col("won"))).alias("won"),
        F.sum(F.when(pu, F.col("price"))).alias("spend"),
        F.min(F.when(ev, d)).alias("first_d"),
        F.max(F.when(ev & (t == "login"), d)).alias("login_d"),
    )
    measures = [c for c in daily.columns if c not in ("player_id", "day", "platform", "region")]
    # days as numbers; an event without a date counts for every compute date, so it stands before all days
    daily = daily.withColumn("k", F.coalesce(F.datediff("day", F.lit(start)), F.lit(-100))).repartition("player_id")

    def so_far(value: str) -> Column:
        upto = Window.partitionBy("player_id", value).orderBy("k").rangeBetween(Window.unboundedPreceding, 0)
        return F.when(F.col(value).isNotNull() & (F.col("n_ev") > 0), F.struct((-F.sum("n_ev").over(upto)).alias("n"), F.col(value).alias("v")))

    order = F.row_number().over(Window.partitionBy("player_id").orderBy("k"))
    daily = daily.select("player_id", "k", "day", *measures, so_far("platform").alias("platform"), so_far("region").alias("region"), order.alias("i"))
    dates = F.sequence(F.greatest(F.coalesce(F.col("day"), F.lit(start)), F.lit(start)), F.lit(end))
    none = F.array(F.lit(None).cast("date"))
    rows = daily.withColumn("c", F.explode(F.when(F.col("i") == 1, F.concat(none, dates)).otherwise(none)))  # compute dates beside the daily rows
    is_day = F.col("c").isNull()
    rows = rows.select("player_id", "c", F.when(is_day, F.col("k")).otherwise(F.datediff("c", F.lit(start))).alias("k"),
                       *(F.when(is_day, F.col(m)).alias(m) for m in (*measures, "platform", "region")))
    by_day = Window.partitionBy("player_id").orderBy("k")
    upto, last7, last30 = (by_day.rangeBetween(lo, 0) for lo in (Window.unboundedPreceding, -7, -30))
    total = lambda m, over: F.coalesce(F.sum(m).over(over), F.lit(0))
    joined = rows.select(
        "player_id", "c", F.sum("n_ev").over(upto).alias("_n_events"),
        F.min("first_d").over(upto).alias("first_seen_date"), F.max("login_d").over(upto).alias("last_login_date"),
        F.min("platform").over(upto)["v"].alias("platform_primary"), F.min("region").over(upto)["v"].alias("region_primary"),
        total("n_login", last7).alias("login_count_7d"), total("n_login", last30).alias("login_count_30d"),
        total("n_kill", last7).alias("kill_count_7d"), total("n_ev", last7).alias("event_count_7d"), total("n_ses", last7).alias("match_count_7d"),
        F.sum("n_dur").over(last7).alias("_n_dur7"), F.sum("secs").over(last7).alias("_sec7"),
        F.sum("n_won").over(last7).alias("_n_won7"), F.sum("won").over(last7).alias("_won7"),
        F.sum("spend").over(last7).alias("_spend7"), F.sum("spend").over(last30).alias("_spend30"),
    ).where(F.col("c").isNotNull() & (F.col("_n_events") > 0))
    c = F.col("c")
    zero_m = F.lit(0).cast(MONEY)
    spend7 = F.coalesce(F.col("_spend7"), zero_m).cast("double")
    spend30 = F.coalesce(F.col("_spend30"), zero_m).cast("double")
    days_since = F.datediff(c, F.col("last_login_date"))
    return joined.select(
        "player_id", c.alias("compute_date"), "first_seen_date", "last_login_date",
        F.col("login_count_7d").cast("long").alias("login_count_7d"),
        F.col("login_count_30d").cast("long").alias("login_count_30d"),
        F.col("kill_count_7d").cast("long").alias("kill_count_7d"),
        F.col("event_count_7d").cast("long").alias("event_count_7d"),
        "platform_primary", "region_primary",
        F.col("match_count_7d").cast("long").alias("match_count_7d"),
        F.coalesce(exact_div(F.col("_sec7"), F.col("_n_dur7") * F.lit(60)), F.lit(0.0)).alias("avg_session_duration_7d"),
        (F.coalesce(F.col("_sec7"), F.lit(0)).cast("double") / F.lit(3600.0)).alias("total_playtime_7d"),
        F.coalesce(exact_div(F.col("_won7"), F.col("_n_won7")), F.lit(0.0)).alias("win_rate_7d"),
        (spend7 / F.lit(7.0)).alias("avg_spend_7d"),
        (spend30 / F.lit(30.0)).alias("avg_spend_30d"),
        spend30.alias("total_spend_30d"),
        days_since.alias("days_since_login"),
        (F.datediff(c, F.col("first_seen_date")) < NEW_PLAYER_DAYS).alias("is_new_player"),
        F.when(days_since >= CHURN_DAYS, 1).otherwise(0).cast("int").alias("churn_label"),
    )
