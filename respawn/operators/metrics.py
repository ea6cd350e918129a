"""Dashboard metrics documented without code.

Distinct-player metrics over sliding windows are computed without exploding
players over days: each (player, day) activity pair covers the calendar days
up to the window length *or* the player's next active day, whichever is first,
so coverage intervals of one player never overlap and a +1/-1 difference
array over the calendar gives exact distinct counts. The only single-partition
step is a running sum over the calendar itself (one row per day -- bounded by
the date range, not by the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from respawn.constants import PLAUSIBLE_DAYS
from respawn.functions.exact import MONEY, exact_div, money, ratio_round
from respawn.functions.quantiles import exact_quantiles
from respawn.operators.dq import VALID_PRICE


def activity_pairs(cleaned: DataFrame) -> DataFrame:
    """Distinct (player_id, day) pairs with at least one event."""
    return (cleaned.where(F.col("event_date").isNotNull())
            .groupBy("player_id", F.col("event_date").alias("day")).agg(F.count(F.lit(1)).alias("events")))


def daily_active(cleaned: DataFrame) -> DataFrame:
    """Daily active players and events per day."""
    return (activity_pairs(cleaned).groupBy(F.col("day").alias("activity_date"))
            .agg(F.count(F.lit(1)).alias("dau"), F.sum("events").alias("events")))


#: log2 of the registers of a sketch; the relative standard error is 1.04 / sqrt(2 ** LG_K) (0.8 %).
LG_K = 14


def daily_sketches(cleaned: DataFrame) -> DataFrame:
    """F8: (activity_date, players): a HyperLogLog sketch of each day's players, to be stored and united over any days."""
    return cleaned.where(F.col("event_date").isNotNull()).groupBy(F.col("event_date").alias("activity_date")).agg(
        F.hll_sketch_agg("player_id", LG_K).alias("players"))


def rolling_from_sketches(sketches: DataFrame, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """N2 from stored sketches alone: (activity_date, active_7d, active_30d, ...) for each day that has a sketch, estimates.

    Each day's sketch goes to the days whose windows hold it (``max(windows)`` at most), where the sketches are united;
    no event is read. Days are unique in ``sketches``.
    """
    most = max(windows)
    sent = sketches.select("players", F.explode(F.sequence("activity_date", F.date_add("activity_date", most - 1))).alias("day"), F.col("activity_date").alias("own"))
    known = sketches.select(F.col("activity_date").alias("day"))
    inside = lambda n: F.when(F.date_diff("day", "own") < n, F.col("players"))
    return sent.join(known, "day", "left_semi").groupBy(F.col("day").alias("activity_date")).agg(
        *(F.hll_sketch_estimate(F.hll_union_agg(inside(n))).alias(f"active_{n}d") for n in windows))


def rolling_active(cleaned: DataFrame, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """DAU, distinct players active in the trailing 7 / 30 days (day d-n+1..d),
    and the mean DAU over the trailing 7 calendar days (missing days count 0).

    One pass: each (player, day) pair emits +1 on its day and, per window, -1
    on the day after its coverage ends (window length, or the player's next
    active day, whichever is first). One aggregate by date turns that into
    per-day deltas; running sums over the calendar (one row per day) give the
    exact distinct counts. Events on implausible days (``PLAUSIBLE_DAYS``) don't count, so a stray date
    can't stretch the calendar.
    """
    cleaned = cleaned.where(F.col("event_date").between(*(F.lit(d).cast("date") for d in PLAUSIBLE_DAYS)))
    pairs = activity_pairs(cleaned)
    p = pairs.withColumn("next_day", F.lead("day").over(Window.partitionBy("player_id").orderBy("day")))
    zero = F.lit(0)
    rows = [F.struct(F.col("day").alias("activity_date"), F.lit(1).alias("dau"),
                     *[F.lit(1).alias(f"d{n}") for n in windows])]
    for n in windows:
        end = F.least(F.date_add(F.col("day"), n - 1),
                      F.coalesce(F.date_sub(F.col("next_day"), 1), F.date_add(F.col("day"), n - 1)))
        rows.append(F.struct(F.date_add(end, 1).alias("activity_date"), zero.alias("dau"),
                             *[(F.lit(-1) if m == n else zero).alias(f"d{m}") for m in windows]))
    deltas = (p.select(F.explode(F.array(*rows)).alias("x")).select("x.*")
              .groupBy("activity_date")
              .agg(F.sum("dau").alias("dau"), *[F.sum(f"d{n}").alias(f"d{n}") for n in windows]))
    # calendar bounds from a narrow scan of the date column (no second shuffle pipeline)
    bounds = cleaned.agg(F.min("event_date").alias("lo"), F.max("event_date").alias("hi"))
    cal = bounds.select(F.explode(F.sequence("lo", "hi")).alias("activity_date"))
    out = cal.join(deltas, "activity_date", "left").fillna(0)
    run = Window.orderBy("activity_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last7 = Window.orderBy("activity_date").rowsBetween(-6, 0)  # calendar rows: one per day
    return out.select(
        "activity_date", F.col("dau").cast("long").alias("dau"),
        *[F.sum(f"d{n}").over(run).cast("long").alias(f"active_{n}d") for n in windows],
        (F.sum("dau").over(last7).cast("double") / F.lit(7.0)).alias("mean_dau_7d"))


def retention_curve(cleaned: DataFrame) -> DataFrame:
    """Share of each first-seen cohort active n days later.

    Offsets past the last observed date are censored (not reported), observed
    offsets with no returning player are reported as 0.
    """
    pairs = activity_pairs(cleaned)
    first = F.min("day").over(Window.partitionBy("player_id"))
    withc = pairs.withColumn("cohort_date", first)
    counts = (withc.groupBy("cohort_date", F.datediff("day", "cohort_date").alias("day_n"))
              .agg(F.count(F.lit(1)).alias("retained")))
    # last observed date: a narrow scan of the date column, not a second shuffle pipeline
    data_end = cleaned.agg(F.max("event_date")).scalar()
    # Single pass, no join: the day-0 row of each cohort also emits a zero row for
    # every observable offset and carries the cohort size; one more reduction
    # merges them with the observed counts.
    day0 = F.col("day_n") == 0
    n = F.explode(F.when(day0, F.sequence(F.lit(0), F.datediff(data_end, F.col("cohort_date"))))
                  .otherwise(F.array(F.col("day_n")))).alias("n")
    spread_rows = counts.select("cohort_date", "day_n", "retained", n)
    out = spread_rows.groupBy("cohort_date", F.col("n").alias("day_n")).agg(
        F.sum(F.when(F.col("n") == F.col("day_n"), F.col("retained")).otherwise(0)).alias("retained"),
        F.max(F.when(day0, F.col("retained"))).alias("cohort_size"))
    return out.select("cohort_date", "day_n", "cohort_size", F.col("retained").cast("long").alias("retained"),
                      ratio_round(F.col("retained"), F.col("cohort_size"), 4).alias("retention_rate"))


def arpu_by_region(cleaned: DataFrame) -> DataFrame:
    """Revenue, active and paying players, ARPU and ARPPU per region (one aggregate)."""
    c = F.col
    valid = (c("event_type_normalized") == "purchase") & F.expr(VALID_PRICE)
    g = cleaned.groupBy("region").agg(
        F.count_distinct("player_id").alias("active_players"),
        F.count_distinct(F.when(valid, c("player_id"))).alias("paying_players"),
        F.coalesce(F.sum(F.when(valid, money("item_price_usd"))), F.lit(0).cast(MONEY)).alias("_rev"),
    )
    return g.select("region", c("_rev").cast("double").alias("revenue_usd"), "active_players", "paying_players",
                    exact_div(c("_rev"), c("active_players")).alias("arpu"),
                    exact_div(c("_rev"), c("paying_players")).alias("arppu"))



def spend_distribution(churn: DataFrame) -> DataFrame:
    """Players and 30-day revenue per spend bucket (free / low / mid / whale),
    with each bucket's share of players and of revenue (4 dp)."""
    s = F.col("total_spend_30d")
    bucket = (F.when(s <= 0, "free").when(s < 20, "low").when(s < 100, "mid").otherwise("whale"))
    g = churn.groupBy(bucket.alias("spend_bucket")).agg(
        F.count(F.lit(1)).alias("players"), F.sum(money(s)).alias("_rev"))
    tot = Window.partitionBy()  # over the <= 4 bucket rows only
    return g.select(
        "spend_bucket", "players", F.col("_rev").cast("double").alias("revenue_usd"),
        ratio_round(F.col("players"), F.sum("players").over(tot), 4).alias("player_share"),
        ratio_round((F.col("_rev") * 100).cast("long"), (F.sum("_rev").over(tot) * 100).cast("long"), 4)
        .alias("revenue_share"),
    )


def spend_percentiles(churn: DataFrame, shares: tuple[float, ...] = (0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """Exact percentiles of the 30-day spend over all players (a row each)."""
    points = exact_quantiles(churn, "total_spend_30d", list(shares))
    asked = churn.sparkSession.createDataFrame([(i, p) for i, p in enumerate(shares)], "i int, percentile double")
    return asked.withColumn("_q", points).select("percentile", F.get("_q", F.col("i")).alias("spend_30d"))


def ltv_by_cohort(cleaned: DataFrame) -> DataFrame:
    """Players, payers, revenue and revenue per player of each first-seen month.

    Every player counts in its cohort, paying or not; one reduction by player, one by month.
    """
    paid = F.when((F.col("event_type_normalized") == "purchase") & F.expr(VALID_PRICE), money("item_price_usd"))
    per_player = cleaned.where(F.col("event_date").isNotNull()).groupBy("player_id").agg(
        F.min("event_date").alias("_first"), F.sum(paid).alias("_rev"), F.count(paid).alias("_n"))
    g = per_player.groupBy(F.trunc("_first", "month").alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("players"), F.count_if(F.col("_n") > 0).alias("payers"),
        F.coalesce(F.sum("_rev"), F.lit(0).cast(MONEY)).alias("_rev"))
    return g.select("cohort_month", "players", "payers", F.col("_rev").cast("double").alias("revenue_usd"),
                    exact_div(F.col("_rev"), F.col("players")).alias("ltv_usd"))


def session_count_distribution(sessions: DataFrame) -> DataFrame:
    """Players by number of sessions, with their mean session length (minutes)."""
    from respawn.operators.silver import duration_seconds
    per = sessions.groupBy("player_id").agg(F.count(F.lit(1)).alias("sessions"),
                                            F.sum(duration_seconds()).alias("_sec"))
    g = per.groupBy("sessions").agg(F.count(F.lit(1)).alias("players"),
                                    F.sum("_sec").alias("_sec"), F.sum("sessions").alias("_n"))
    return g.select(F.col("sessions").alias("sessions_per_player"), "players",
                    exact_div(F.col("_sec"), F.col("_n") * F.lit(60)).alias("avg_session_min"))


def platform_region(cleaned: DataFrame) -> DataFrame:
    """Events and distinct players per platform x region."""
    return cleaned.groupBy("platform", "region").agg(
        F.count(F.lit(1)).alias("events"), F.count_distinct("player_id").alias("players"))


def win_rate_by_tier(sessions: DataFrame) -> DataFrame:
    """Session win rate per skill tier; tier = quartile of the player's K/D
    (kills / (deaths + 1) over all sessions). The quartiles are exact and exposed
    as a scalar subquery -- no collect."""
    per = sessions.groupBy("player_id").agg(
        F.sum("kills").alias("_k"), F.sum("deaths").alias("_d"),
        F.count(F.lit(1)).alias("sessions"), F.sum("matches_won").alias("won"))
    per = per.withColumn("kd", F.col("_k").cast("double") / (F.col("_d") + F.lit(1)).cast("double"))
    q = exact_quantiles(per, "kd", [0.25, 0.5, 0.75])
    # tier = 1 + number of cut points below the player's K/D; the cut points are
    # projected once as a column, so the subquery runs once
    per = per.withColumn("_q", q)
    tier = (F.size(F.filter("_q", lambda cut: F.col("kd") > cut)) + F.lit(1)).cast("int")
    g = per.groupBy(tier.alias("skill_tier")).agg(
        F.count(F.lit(1)).alias("players"), F.sum("sessions").alias("sessions"), F.sum("won").alias("_won"),
        F.min("kd").alias("min_kd"), F.max("kd").alias("max_kd"))
    return g.select("skill_tier", "players", "sessions", "min_kd", "max_kd",
                    ratio_round(F.col("_won"), F.col("sessions"), 4).alias("win_rate"))
