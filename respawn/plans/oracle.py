"""Independent SQL formulations of the registered queries (DuckDB dialect).

Used only for verification: each string runs on the benchmark tables
registered as views and must return the same rows as the Spark query. The
base CTEs restate the adapter, bronze, silver and gold definitions in plain
SQL; gold is written the reference's way (three aggregates + left joins), so
it independently checks the single-reduction Spark plan.
"""

from __future__ import annotations

from respawn.constants import (EVENT_TYPES, GAME_MODES, LOGOUT_REASONS, PAYMENT_METHODS,
                               PLATFORMS, REGIONS, SKINS, WEAPONS)
from respawn.sources.driver import IP_COUNTRIES

AS_OF = "(SELECT max(CAST(ts AS DATE)) FROM events)"
FIRST_DAY = "(SELECT min(CAST(ts AS DATE)) FROM events)"


def _lst(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


ITEM_NAMES = [s.replace("_", " ").title() + " Skin" for s in SKINS]


def _p(key: str) -> str:
    return f"CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.{key}') END"


RAW = f"""
raw0 AS (
  SELECT event_id AS e, user_id AS u, ts,
    CASE WHEN event_type = 'view' THEN CASE WHEN event_id % 4 = 0 THEN 'logout' ELSE 'session_end' END
         WHEN event_type = 'signup' THEN 'login' WHEN event_type = 'click' THEN 'kill'
         WHEN event_type = 'error' THEN 'death' WHEN event_type = 'purchase' THEN 'purchase'
         ELSE event_type END AS etype,
    TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CAST(floor(value * 20) AS BIGINT) AS cents
  FROM events),
raw1 AS (
  SELECT *, unnest(CASE WHEN e % 50 = 0 THEN [0, 1] ELSE [0] END) AS copy,
    {_lst(REGIONS)}[(CASE WHEN e % 5 = 0 THEN e ELSE u END) % 4 + 1] AS reg0,
    {_lst(PLATFORMS)}[(CASE WHEN e % 5 = 0 THEN e ELSE u END) % 3 + 1] AS plat0,
    {_lst(GAME_MODES)}[e % 4 + 1] AS mode0,
    {_lst(WEAPONS)}[k % 5 + 1] AS weapon0,
    'player_' || CAST(u + k AS VARCHAR) AS other0
  FROM raw0),
raw2 AS (
  SELECT *, CASE
    WHEN etype = 'login' THEN '{{"session_token": "' || md5(CAST(e AS VARCHAR)) || '", "ip_country": "' || {_lst(IP_COUNTRIES)}[u % 4 + 1] || '"}}'
    WHEN etype = 'kill' THEN '{{"opponent_id": "' || other0 || '", "weapon": "' || weapon0 || '", "headshot": ' || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END || ', "experience_granted": ' || CAST(50 + k AS VARCHAR) || '}}'
    WHEN etype = 'death' THEN '{{"killed_by": "' || other0 || '", "weapon": "' || weapon0 || '", "distance_m": ' || CAST(5 + k AS VARCHAR) || '}}'
    WHEN etype = 'purchase' THEN '{{"item_id": "skin_' || {_lst(SKINS)}[k % 5 + 1] || '", "item_name": "' || {_lst(ITEM_NAMES)}[k % 5 + 1] || '", "item_price_usd": ' || CAST(cents // 100 AS VARCHAR) || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') || ', "currency": "USD", "payment_method": "' || {_lst(PAYMENT_METHODS)}[e % 4 + 1] || '"}}'
    WHEN etype = 'session_end' THEN '{{"total_kills": ' || CAST(k AS VARCHAR) || ', "total_deaths": ' || CAST(e % 51 AS VARCHAR) || ', "total_earned_xp": ' || CAST(100 + 100 * k AS VARCHAR) || ', "duration_seconds": ' || CAST(300 + e % 6901 AS VARCHAR) || ', "items_purchased": ' || CAST(k % 6 AS VARCHAR) || '}}'
    ELSE '{{"reason": "' || {_lst(LOGOUT_REASONS)}[e % 3 + 1] || '"}}' END AS payload0
  FROM raw1),
raw AS (
  SELECT
    CASE WHEN e % 103 <> 0 THEN CAST(e AS VARCHAR) END AS event_id,
    CASE WHEN e % 101 <> 0 THEN 'player_' || CAST(u AS VARCHAR) END AS player_id,
    CASE WHEN e % 97 = 0 THEN 'unknown' ELSE etype END AS event_type,
    CASE WHEN e % 211 = 0 THEN 'not-a-time' ELSE CAST(ts AS VARCHAR) END AS "timestamp",
    CASE WHEN etype = 'logout' THEN NULL WHEN e % 7 = 0 THEN ' ' || mode0 || ' ' ELSE mode0 END AS game_mode,
    CASE WHEN e % 7 = 0 THEN lower(reg0) ELSE reg0 END AS region,
    CASE WHEN e % 7 = 0 THEN ' ' || lower(plat0) || ' ' ELSE plat0 END AS platform,
    CASE WHEN e % 89 = 0 THEN substring(payload0, 1, 12) ELSE payload0 END AS payload,
    CAST(ts + to_seconds(CAST(e % 10 + 1 + copy * 3600 AS BIGINT)) AS VARCHAR) AS ingest_ts,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS ingest_date
  FROM raw2)"""

BRONZE = f"""
bronze AS (
  SELECT * FROM raw
  WHERE event_id IS NOT NULL AND player_id IS NOT NULL AND coalesce(event_type IN {_in(EVENT_TYPES)}, false))"""

CLEANED = f"""
typed AS (
  SELECT event_id, player_id, lower(trim(event_type)) AS event_type_normalized,
    TRY_CAST("timestamp" AS TIMESTAMP) AS event_ts, TRY_CAST(ingest_ts AS TIMESTAMP) AS ingest_ts,
    TRY_CAST(ingest_date AS DATE) AS ingest_date, trim(game_mode) AS game_mode,
    upper(trim(region)) AS region,
    CASE lower(trim(platform)) WHEN 'pc' THEN 'PC' WHEN 'console' THEN 'Console'
         WHEN 'mobile' THEN 'Mobile' ELSE trim(platform) END AS platform,
    payload
  FROM bronze),
deduped AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY event_id, CASE WHEN event_id IS NULL THEN md5(concat_ws('|', player_id, event_type_normalized, CAST(event_ts AS VARCHAR), payload, CAST(ingest_ts AS VARCHAR))) END
      ORDER BY ingest_ts NULLS FIRST, payload NULLS FIRST, event_ts NULLS FIRST, player_id NULLS FIRST,
               event_type_normalized NULLS FIRST, game_mode NULLS FIRST, region NULLS FIRST,
               platform NULLS FIRST, ingest_date NULLS FIRST) AS rn
    FROM typed) WHERE rn = 1),
parsed AS (
  SELECT event_id, player_id, event_type_normalized, event_ts, ingest_ts, ingest_date, game_mode,
    region, platform, payload, CAST(event_ts AS DATE) AS event_date,
    coalesce({_p('opponent_id')}, {_p('killed_by')}) AS opponent_id,
    {_p('weapon')} AS weapon,
    TRY_CAST({_p('headshot')} AS BOOLEAN) AS headshot,
    {_p('item_id')} AS item_id,
    {_p('item_name')} AS item_name,
    TRY_CAST({_p('item_price_usd')} AS DOUBLE) AS item_price_usd,
    {_p('payment_method')} AS payment_method,
    TRY_CAST({_p('experience_granted')} AS INTEGER) AS experience_granted,
    TRY_CAST({_p('duration_seconds')} AS INTEGER) AS session_duration_seconds,
    TRY_CAST({_p('total_kills')} AS INTEGER) AS session_kills,
    TRY_CAST({_p('total_deaths')} AS INTEGER) AS session_deaths,
    TRY_CAST({_p('total_earned_xp')} AS INTEGER) AS session_xp,
    TRY_CAST({_p('items_purchased')} AS INTEGER) AS session_items_purchased
  FROM deduped),
cleaned AS (
  SELECT * FROM parsed
  WHERE event_id IS NOT NULL AND player_id IS NOT NULL
    AND coalesce(event_type_normalized IN {_in(EVENT_TYPES)}, false))"""

SILVER = """
session_cand AS (
  SELECT
    sha256(concat_ws(':', player_id, CAST(event_ts AS VARCHAR), event_id)) AS session_id,
    player_id, event_ts AS session_end_ts,
    date_trunc('second', event_ts) - to_seconds(CAST(session_duration_seconds AS BIGINT)) AS session_start_ts,
    CAST(session_duration_seconds AS DOUBLE) / 60.0::DOUBLE AS duration_min,
    game_mode, region, platform,
    coalesce(session_kills, 0) AS kills, coalesce(session_deaths, 0) AS deaths,
    CAST(coalesce(session_kills, 0) AS DOUBLE) / CAST(coalesce(session_deaths, 0) + 1 AS DOUBLE) AS kd_ratio,
    1 AS matches_played,
    CASE WHEN coalesce(session_kills, 0) >= coalesce(session_deaths, 0) THEN 1 ELSE 0 END AS matches_won,
    coalesce(session_items_purchased, 0) AS items_purchased,
    coalesce(session_xp, 0) AS experience_gain,
    event_date AS session_date,
    CAST(CASE WHEN coalesce(session_kills, 0) >= coalesce(session_deaths, 0) THEN 1 ELSE 0 END AS DOUBLE) / 1.0::DOUBLE AS win_rate
  FROM cleaned WHERE event_type_normalized = 'session_end'),
sessions AS (
  SELECT * FROM session_cand
  WHERE session_id IS NOT NULL AND player_id IS NOT NULL AND coalesce(duration_min > 0, false)),
purchase_cand AS (
  SELECT event_id, player_id, event_ts, event_date, region, platform, item_id, item_name,
         item_price_usd, payment_method
  FROM cleaned WHERE event_type_normalized = 'purchase'),
purchases AS (
  SELECT * FROM purchase_cand
  WHERE coalesce(item_price_usd >= 0 AND item_price_usd < 1e16, false))"""


def _churn_cte(as_of: str = AS_OF, name: str = "churn") -> str:
    def w(days, col="d"):
        return f"({col} >= {as_of} - INTERVAL {days} DAY AND {col} <= {as_of})"
    return f"""
{name}_act AS (
  SELECT player_id,
    min(event_date) FILTER (WHERE event_date <= {as_of}) AS first_seen_date,
    max(event_date) FILTER (WHERE event_type_normalized = 'login' AND event_date <= {as_of}) AS last_login_date,
    count(*) FILTER (WHERE event_type_normalized = 'login' AND {w(7, 'event_date')}) AS login_count_7d,
    count(*) FILTER (WHERE event_type_normalized = 'login' AND {w(30, 'event_date')}) AS login_count_30d,
    count(*) FILTER (WHERE event_type_normalized = 'kill' AND {w(7, 'event_date')}) AS kill_count_7d,
    count(*) FILTER (WHERE {w(7, 'event_date')}) AS event_count_7d
  FROM cleaned GROUP BY player_id
  HAVING count(*) FILTER (WHERE event_date <= {as_of} OR event_date IS NULL) > 0),
{name}_plat AS (
  SELECT player_id, platform AS platform_primary FROM (
    SELECT player_id, platform, row_number() OVER (PARTITION BY player_id ORDER BY n DESC, platform) AS rn
    FROM (SELECT player_id, platform, count(*) AS n FROM cleaned
          WHERE platform IS NOT NULL AND (event_date <= {as_of} OR event_date IS NULL)
          GROUP BY player_id, platform)) WHERE rn = 1),
{name}_reg AS (
  SELECT player_id, region AS region_primary FROM (
    SELECT player_id, region, row_number() OVER (PARTITION BY player_id ORDER BY n DESC, region) AS rn
    FROM (SELECT player_id, region, count(*) AS n FROM cleaned
          WHERE region IS NOT NULL AND (event_date <= {as_of} OR event_date IS NULL)
          GROUP BY player_id, region)) WHERE rn = 1),
{name}_ses AS (
  SELECT player_id,
    count(*) FILTER (WHERE {w(7, 'session_date')}) AS match_count_7d,
    count(duration_min) FILTER (WHERE {w(7, 'session_date')}) AS n_dur7,
    sum(CAST(floor(duration_min * 60.0 + 0.5) AS BIGINT)) FILTER (WHERE {w(7, 'session_date')}) AS sec7,
    count(matches_won) FILTER (WHERE {w(7, 'session_date')}) AS n_won7,
    sum(matches_won) FILTER (WHERE {w(7, 'session_date')}) AS won7
  FROM sessions GROUP BY player_id),
{name}_spend AS (
  SELECT player_id,
    sum(CAST(item_price_usd AS DECIMAL(18,2))) FILTER (WHERE {w(7, 'event_date')}) AS spend7,
    sum(CAST(item_price_usd AS DECIMAL(18,2))) FILTER (WHERE {w(30, 'event_date')}) AS spend30
  FROM purchases GROUP BY player_id),
{name} AS (
  SELECT a.player_id, {as_of} AS compute_date, a.first_seen_date, a.last_login_date,
    a.login_count_7d, a.login_count_30d, a.kill_count_7d, a.event_count_7d,
    p.platform_primary, r.region_primary,
    coalesce(s.match_count_7d, 0) AS match_count_7d,
    coalesce(CASE WHEN s.n_dur7 * 60 <> 0 THEN CAST(s.sec7 AS DOUBLE) / CAST(s.n_dur7 * 60 AS DOUBLE) END, 0.0) AS avg_session_duration_7d,
    CAST(coalesce(s.sec7, 0) AS DOUBLE) / 3600.0::DOUBLE AS total_playtime_7d,
    coalesce(CASE WHEN s.n_won7 <> 0 THEN CAST(s.won7 AS DOUBLE) / CAST(s.n_won7 AS DOUBLE) END, 0.0) AS win_rate_7d,
    CAST(coalesce(sp.spend7, 0) AS DOUBLE) / 7.0::DOUBLE AS avg_spend_7d,
    CAST(coalesce(sp.spend30, 0) AS DOUBLE) / 30.0::DOUBLE AS avg_spend_30d,
    CAST(coalesce(sp.spend30, 0) AS DOUBLE) AS total_spend_30d,
    CAST(date_diff('day', a.last_login_date, {as_of}) AS INTEGER) AS days_since_login,
    date_diff('day', a.first_seen_date, {as_of}) < 30 AS is_new_player,
    CAST(CASE WHEN date_diff('day', a.last_login_date, {as_of}) >= 7 THEN 1 ELSE 0 END AS INTEGER) AS churn_label
  FROM {name}_act a
  LEFT JOIN {name}_plat p USING (player_id)
  LEFT JOIN {name}_reg r USING (player_id)
  LEFT JOIN {name}_ses s USING (player_id)
  LEFT JOIN {name}_spend sp USING (player_id))"""


def base(*extra: str) -> str:
    ctes = [RAW, BRONZE, CLEANED, SILVER, _churn_cte()] + list(extra)
    return "WITH " + ",".join(ctes) + "\n"


def q(select: str, *extra: str) -> str:
    return base(*extra) + select


CHURN_COLS = ("player_id, compute_date, first_seen_date, last_login_date, login_count_7d, "
              "login_count_30d, kill_count_7d, event_count_7d, platform_primary, region_primary, "
              "match_count_7d, avg_session_duration_7d, total_playtime_7d, win_rate_7d, "
              "avg_spend_7d, avg_spend_30d, total_spend_30d, days_since_login, is_new_player, churn_label")


def rr(num: str, den: str, d: int) -> str:
    """Half-up rounding of num/den to d decimals with integer arithmetic (NULL if den = 0)."""
    n, dd = f"CAST(({num}) AS BIGINT)", f"CAST(({den}) AS BIGINT)"
    return (f"(CASE WHEN {dd} > 0 THEN CAST(({n} * {2 * 10 ** d} + {dd}) // ({dd} * 2) AS DOUBLE)"
            f" / {float(10 ** d)}::DOUBLE END)")


def units(x: str, scale: int) -> str:
    return f"CAST(floor(({x}) * {float(scale)}::DOUBLE + 0.5::DOUBLE) AS BIGINT)"


def cents_sum(x: str) -> str:
    return f"CAST(sum(CAST(({x}) AS DECIMAL(18,2))) * 100 AS BIGINT)"


def ediv(num: str, den: str) -> str:
    return f"(CASE WHEN ({den}) <> 0 THEN CAST(({num}) AS DOUBLE) / CAST(({den}) AS DOUBLE) END)"


def msum(x: str) -> str:
    return f"sum(CAST(({x}) AS DECIMAL(18,2)))"


def _arpu_cte(as_of: str = AS_OF) -> str:
    def w(days):
        return f"(event_date >= {as_of} - INTERVAL {days} DAY AND event_date <= {as_of})"
    t90 = "CAST(coalesce(s90, 0) AS DOUBLE)"
    return f"""
arpu_agg AS (
  SELECT player_id,
    {msum('item_price_usd')} FILTER (WHERE {w(7)}) AS s7,
    {msum('item_price_usd')} FILTER (WHERE {w(30)}) AS s30,
    {msum('item_price_usd')} FILTER (WHERE {w(90)}) AS s90,
    {msum('item_price_usd')} FILTER (WHERE event_date <= {as_of}) AS sall,
    count(item_price_usd) FILTER (WHERE event_date <= {as_of}) AS nall,
    count(*) FILTER (WHERE {w(7)}) AS purchase_frequency_7d,
    count(*) FILTER (WHERE {w(30)}) AS purchase_frequency_30d,
    min(event_date) FILTER (WHERE event_date <= {as_of}) AS first_purchase_date,
    max(event_date) FILTER (WHERE event_date <= {as_of}) AS last_purchase_date
  FROM purchases GROUP BY player_id
  HAVING count(*) FILTER (WHERE event_date <= {as_of}) > 0),
first_seen AS (
  SELECT player_id, min(event_date) FILTER (WHERE event_date <= {as_of}) AS first_seen_date
  FROM cleaned GROUP BY player_id),
arpu AS (
  SELECT a.player_id, {as_of} AS compute_date,
    CAST(coalesce(s7, 0) AS DOUBLE) / 7.0::DOUBLE AS avg_spend_7d,
    CAST(coalesce(s30, 0) AS DOUBLE) / 30.0::DOUBLE AS avg_spend_30d,
    {t90} AS total_spend_90d,
    {ediv('sall', 'nall')} AS avg_spend_all_time,
    purchase_frequency_7d, purchase_frequency_30d, first_purchase_date, last_purchase_date,
    f.first_seen_date,
    CAST(date_diff('day', first_purchase_date, {as_of}) AS INTEGER) AS days_since_first_purchase,
    CAST(date_diff('day', last_purchase_date, {as_of}) AS INTEGER) AS days_since_last_purchase,
    CASE WHEN {t90} >= 250 THEN 'platinum' WHEN {t90} >= 100 THEN 'gold' WHEN {t90} >= 50 THEN 'silver'
         WHEN {t90} > 0 THEN 'bronze' ELSE 'free' END AS premium_tier,
    {t90} >= 250 AS is_whale
  FROM arpu_agg a LEFT JOIN first_seen f USING (player_id))"""


SEGMENTS = """
segments AS (
  SELECT player_id, compute_date, region_primary, platform_primary, days_since_login,
    login_count_7d, total_spend_30d, avg_session_duration_7d, win_rate_7d,
    CASE WHEN days_since_login >= 14 THEN 'lapsed' WHEN login_count_7d >= 5 THEN 'core'
         WHEN login_count_7d >= 2 THEN 'regular' ELSE 'casual' END AS engagement_segment,
    CASE WHEN total_spend_30d >= 100 THEN 'whale' WHEN total_spend_30d >= 20 THEN 'spender'
         ELSE 'free' END AS revenue_segment
  FROM churn)"""

SCORES = """
scores0 AS (
  SELECT *, CAST(coalesce(days_since_login, 30) AS BIGINT) + 1 AS dd FROM churn),
scores AS (
  SELECT player_id, compute_date,
    CASE WHEN dd + login_count_7d <> 0 THEN CAST(dd AS DOUBLE) / CAST(dd + login_count_7d AS DOUBLE) END AS churn_probability,
    days_since_login, login_count_7d, total_spend_30d, platform_primary, region_primary
  FROM scores0),
scored AS (
  SELECT *, CASE WHEN churn_probability IS NULL OR isnan(churn_probability) THEN NULL
                 WHEN churn_probability >= 0.75::DOUBLE THEN 'high'
                 WHEN churn_probability >= 0.4::DOUBLE THEN 'medium' ELSE 'low' END AS risk_tier
  FROM scores)"""


def _gold_base(*extra: str) -> str:
    return base(_arpu_cte(), SEGMENTS, SCORES, *extra)


def g(select: str, *extra: str) -> str:
    return _gold_base(*extra) + select


#: The expectations as the contract states them: dataset -> relation and (rule, action, predicate).
RULES = {
    "raw_events": ("raw", [
        ("valid_event_id", "drop", "event_id IS NOT NULL"), ("valid_player_id", "drop", "player_id IS NOT NULL"),
        ("valid_event_type", "drop", "event_type IN ('login', 'kill', 'death', 'purchase', 'session_end', 'logout')")]),
    "player_events_cleaned": ("parsed", [
        ("valid_event_id", "drop", "event_id IS NOT NULL"), ("valid_player_id", "drop", "player_id IS NOT NULL"),
        ("valid_event_type", "drop", "event_type_normalized IN ('login', 'kill', 'death', 'purchase', 'session_end', 'logout')"),
        ("known_game_mode", "warn", "game_mode IS NULL OR game_mode IN ('deathmatch', 'capture_flag', 'ranked', 'casual')"),
        ("known_region", "warn", "region IS NULL OR region IN ('NA', 'EU', 'APAC', 'LATAM')"),
        ("known_platform", "warn", "platform IS NULL OR platform IN ('PC', 'Console', 'Mobile')")]),
    "player_sessions": ("session_cand", [
        ("valid_session_id", "drop", "session_id IS NOT NULL"), ("valid_player_id", "drop", "player_id IS NOT NULL"),
        ("positive_duration", "drop", "duration_min > 0"), ("non_negative_kills", "warn", "kills >= 0"),
        ("non_negative_deaths", "warn", "deaths >= 0")]),
    "player_purchase_events": ("purchase_cand", [("valid_purchase_amount", "drop", "item_price_usd >= 0 AND item_price_usd < 1e16")]),
    "churn_features_daily": ("churn", [("valid_player_id", "drop", "player_id IS NOT NULL"), ("valid_compute_date", "drop", "compute_date IS NOT NULL")]),
    "arpu_features_daily": ("arpu", [("valid_player_id", "drop", "player_id IS NOT NULL")]),
}


def _metrics_sql(dataset: str) -> str:
    rel, rules = RULES[dataset]
    aggs = ", ".join(f"count(*) FILTER (WHERE NOT coalesce(({p}), false)) AS f{i}" for i, (_, _, p) in enumerate(rules))
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{name}' AS rule, '{action}' AS action, total, total - f{i} AS passed, f{i} AS failed, "
        f"{rr(f'(total - f{i}) * 100', 'total', 2)} AS pass_pct FROM (SELECT count(*) AS total, {aggs} FROM {rel})"
        for i, (name, action, _) in enumerate(rules))


VIEW_RET = f"""
vw_ret AS (
  SELECT compute_date, region_primary AS region, platform_primary AS platform, risk_tier,
    count(*) AS players,
    {rr("sum(" + units("churn_probability", 1_000_000) + ")", "count(churn_probability) * 1000000", 6)} AS avg_churn_probability,
    {ediv("sum(days_since_login)", "count(days_since_login)")} AS avg_days_since_login,
    {ediv(msum("total_spend_30d"), "count(total_spend_30d)")} AS avg_spend_30d
  FROM scored GROUP BY ALL)"""

VIEW_ARPU = f"""
vw_arpu AS (
  SELECT compute_date, premium_tier, count(*) AS paying_players,
    {rr("sum(" + units("avg_spend_7d", 1_000_000) + ")", "count(*) * 1000000", 6)} AS avg_spend_7d,
    {rr("sum(" + units("avg_spend_30d", 1_000_000) + ")", "count(*) * 1000000", 6)} AS avg_spend_30d,
    CAST({msum("total_spend_90d")} AS DOUBLE) AS total_spend_90d,
    {ediv("sum(purchase_frequency_30d)", "count(*)")} AS avg_purchase_frequency_30d
  FROM arpu GROUP BY ALL)"""


def _mode_cte(name: str, col: str, rel: str, where: str) -> str:
    return f"""
{name} AS (
  SELECT player_id, {col} AS {col}_primary FROM (
    SELECT player_id, {col}, row_number() OVER (PARTITION BY player_id ORDER BY n DESC, {col}) AS rn
    FROM (SELECT player_id, {col}, count(*) AS n FROM {rel} WHERE {col} IS NOT NULL AND ({where})
          GROUP BY player_id, {col})) WHERE rn = 1)"""


def _pit_sql() -> str:
    fe = f"CAST({AS_OF} - INTERVAL 7 DAY AS DATE)"
    cols = CHURN_COLS.replace(", churn_label", "")
    fut = f"""
pit_future AS (
  SELECT player_id, count(*) FILTER (WHERE event_type_normalized = 'login' AND event_date > {fe}
                                     AND event_date <= {fe} + INTERVAL 7 DAY) AS fl
  FROM cleaned GROUP BY player_id)"""
    return q(f"SELECT {', '.join('c.' + x.strip() for x in cols.split(','))}, {AS_OF} AS label_window_end, "
             f"CAST(CASE WHEN coalesce(f.fl, 0) > 0 THEN 0 ELSE 1 END AS INTEGER) AS churn_label "
             f"FROM pit c LEFT JOIN pit_future f USING (player_id)",
             _churn_cte(fe, "pit"), fut)


def oracle_sql() -> dict[str, str]:
    t = "event_type_normalized"
    kd_micro = "((CAST(kills AS BIGINT) * 2000000 + (deaths + 1)) // (2 * (CAST(deaths AS BIGINT) + 1)))"
    secs = units("duration_min", 60)
    warn = [r for r in RULES["player_events_cleaned"][1] if r[1] == "warn"]
    flags = ", ".join(f"CASE WHEN NOT coalesce(({p}), false) THEN '{name}' END" for name, _, p in warn)
    metrics = " UNION ALL ".join(map(_metrics_sql, RULES))
    raw_cols = ["event_id", "player_id", "event_type", "timestamp", "game_mode", "region",
                "platform", "payload", "ingest_ts", "ingest_date"]
    nulls = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS null_{c}' for c in raw_cols)
    ts = 'TRY_CAST("timestamp" AS TIMESTAMP)'
    pj = lambda k: f"CASE WHEN json_valid(payload) THEN json_extract_string(payload, '$.{k}') END"
    prim_where = f"event_date <= {AS_OF} OR event_date IS NULL"
    return {
        "churn_features_daily": q(f"SELECT {CHURN_COLS} FROM churn"),
        "clean_events": q("SELECT * FROM cleaned"),
        "stream_merged_events": q("SELECT * FROM cleaned"),
        "player_sessions": q("SELECT * FROM sessions"),
        "purchase_events": q("SELECT * FROM purchases"),
        # B
        "dq_drop": q("SELECT * FROM bronze"),
        "dq_warn": q(f"SELECT event_id, game_mode, region, platform, concat_ws(',', {flags}) AS dq_failed FROM cleaned"),
        "dq_metrics": g(metrics),
        "raw_summary": q(f"SELECT count(*) AS total_events, count(DISTINCT player_id) AS unique_players, "
                         f"count(DISTINCT CAST({ts} AS DATE)) AS days_covered, min({ts}) AS first_event, "
                         f"max({ts}) AS last_event FROM bronze"),
        "null_profile": q(f'SELECT count(*) AS "rows", {nulls} FROM raw'),
        "event_dist": q("SELECT event_type, count(*) AS events FROM bronze GROUP BY event_type"),
        "distinct_types": q("SELECT DISTINCT event_type FROM bronze"),
        "bronze_quality": q("SELECT event_type, count(*) AS events, count(DISTINCT player_id) AS players, "
                            "count(*) FILTER (WHERE payload IS NULL) AS missing_payloads FROM bronze GROUP BY event_type"),
        "silver_quality_summary": q(f"SELECT event_date, {t}, count(*) AS event_count, count(DISTINCT player_id) AS unique_players, "
                                    f"CAST(sum(CASE WHEN payload IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_payload_count "
                                    f"FROM cleaned GROUP BY event_date, {t}"),
        "dup_check": q("SELECT 'bronze' AS layer, count(*) AS \"rows\", count(DISTINCT event_id) AS unique_ids, "
                       "count(*) - count(DISTINCT event_id) AS dupes FROM bronze UNION ALL "
                       "SELECT 'cleaned', count(*), count(DISTINCT event_id), count(*) - count(DISTINCT event_id) FROM cleaned"),
        "cleaned_profile": q("SELECT count(*) AS \"rows\", count(DISTINCT event_id) AS unique_events, "
                             "count(DISTINCT player_id) AS unique_players, min(event_ts) AS first_event, "
                             "max(event_ts) AS last_event FROM cleaned"),
        # C
        "kill_events": q(f"SELECT event_id, player_id, event_ts, opponent_id, weapon, headshot, experience_granted "
                         f"FROM cleaned WHERE {t} = 'kill'"),
        "revenue_by_region_platform": q(f"SELECT region, platform, count(*) AS purchases, "
                                        f"CAST({msum('item_price_usd')} AS DOUBLE) AS revenue_usd FROM purchases GROUP BY region, platform"),
        "session_metrics": q(f"SELECT region, platform, count(*) AS sessions, "
                             f"{rr('sum(' + secs + ')', 'count(*) * 60', 2)} AS avg_duration_min, "
                             f"{rr('sum(' + kd_micro + ')', 'count(*) * 1000000', 2)} AS avg_kd_ratio, "
                             f"{rr('sum(matches_won)', 'count(*)', 2)} AS avg_win_rate FROM sessions GROUP BY region, platform"),
        # D
        "filter_predicates": q(f"SELECT event_id, player_id, {t}, region, game_mode, item_price_usd FROM cleaned WHERE "
                               f"({t} = 'purchase' AND item_price_usd >= 10.0 AND region IN ('NA', 'EU')) OR "
                               f"({t} = 'session_end' AND session_duration_seconds IS NULL) OR "
                               f"(game_mode IS NULL AND {t} <> 'logout')"),
        "date_window_filter": q(f"SELECT event_id, player_id, {t}, event_date FROM cleaned "
                                f"WHERE event_date >= {AS_OF} - INTERVAL 7 DAY AND event_date <= {AS_OF}"),
        # E
        "left_join_features": q(f"SELECT {CHURN_COLS} FROM churn"),
        "left_join_first_seen": g("SELECT * FROM arpu"),
        # F
        "conditional_aggs": q(f"""SELECT event_date, count(*) AS events,
            count(*) FILTER (WHERE {t} = 'login') AS logins, count(*) FILTER (WHERE {t} = 'kill') AS kills,
            CAST(coalesce({msum('item_price_usd')} FILTER (WHERE {t} = 'purchase'), 0) AS DOUBLE) AS purchase_revenue,
            {ediv(msum('item_price_usd') + f" FILTER (WHERE {t} = 'purchase')", f"count(item_price_usd) FILTER (WHERE {t} = 'purchase')")} AS avg_purchase_usd,
            {ediv(f"sum(session_duration_seconds) FILTER (WHERE {t} = 'session_end')", f"count(session_duration_seconds) FILTER (WHERE {t} = 'session_end') * 60")} AS avg_session_min
            FROM cleaned GROUP BY event_date"""),
        "basic_aggs": q(f"""SELECT region, count(*) AS purchases, CAST({msum('item_price_usd')} AS DOUBLE) AS revenue_usd,
            {ediv(msum('item_price_usd'), 'count(*)')} AS avg_price, min(item_price_usd) AS min_price,
            max(item_price_usd) AS max_price, min(event_date) AS first_purchase_date,
            max(event_date) AS last_purchase_date, count(DISTINCT player_id) AS buyers
            FROM purchases GROUP BY region"""),
        "primary_mode": q("SELECT p.player_id, a.platform_primary, b.region_primary, c.game_mode_primary "
                          f"FROM (SELECT DISTINCT player_id FROM cleaned WHERE {prim_where}) p "
                          "LEFT JOIN m_plat a USING (player_id) LEFT JOIN m_reg b USING (player_id) "
                          "LEFT JOIN m_mode c USING (player_id)",
                          _mode_cte("m_plat", "platform", "cleaned", prim_where),
                          _mode_cte("m_reg", "region", "cleaned", prim_where),
                          _mode_cte("m_mode", "game_mode", "cleaned", prim_where)),
        "whale_p95": g("SELECT player_id, total_spend_90d, thr AS whale_threshold, total_spend_90d > thr AS is_whale "
                       "FROM arpu, (SELECT quantile_disc(total_spend_90d, 0.95) AS thr FROM arpu)"),
        "grouping_levels": q(f"SELECT region, platform, {t}, CAST(GROUPING(region, platform, {t}) AS INTEGER) AS level, "
                             f"count(*) AS events, count(DISTINCT player_id) AS players FROM cleaned "
                             f"GROUP BY ROLLUP (region, platform, {t})"),
        # J
        "scalar_string": q(f"SELECT event_id, upper(player_id) AS player_upper, lower(region) AS region_lower, "
                           f"trim('  ' || {t} || ' ') AS type_trimmed, concat_ws(':', player_id, {t}, platform) AS event_key, "
                           f"sha256(concat_ws(':', player_id, {t}, platform)) AS event_key_sha256, "
                           f"CAST(length(platform) AS INTEGER) AS platform_len FROM cleaned"),
        "scalar_datetime": q(f"""SELECT event_id, event_date, CAST(hour(event_ts) AS INTEGER) AS event_hour,
            CAST(epoch(date_trunc('second', event_ts)) AS BIGINT) AS event_unix,
            strftime(date_trunc('second', event_ts), '%Y-%m-%d %H:%M:%S') AS event_second_text,
            CAST(event_date - INTERVAL 7 DAY AS DATE) AS week_before,
            CAST(date_diff('day', event_date, {AS_OF}) AS INTEGER) AS days_to_as_of,
            CAST(date_trunc('month', event_date) AS DATE) AS event_month,
            CAST(epoch(date_trunc('second', ingest_ts)) AS BIGINT) - CAST(epoch(date_trunc('second', event_ts)) AS BIGINT) AS ingest_lag_s
            FROM cleaned"""),
        "scalar_json": q(f"SELECT event_id, {pj('weapon')} AS weapon, TRY_CAST({pj('headshot')} AS BOOLEAN) AS headshot, "
                         f"TRY_CAST({pj('item_price_usd')} AS DOUBLE) AS item_price_usd, "
                         f"TRY_CAST({pj('total_kills')} AS INTEGER) AS total_kills, {pj('reason')} AS reason, "
                         f"coalesce({pj('opponent_id')}, {pj('killed_by')}) AS opponent_id FROM bronze"),
        "scalar_cast": q(f"SELECT event_id, {ts} AS event_ts, TRY_CAST(ingest_date AS DATE) AS ingest_date, "
                         f"TRY_CAST(event_id AS BIGINT) AS event_num, TRY_CAST({pj('headshot')} AS BOOLEAN) AS headshot, "
                         f"TRY_CAST({pj('duration_seconds')} AS INTEGER) AS duration_seconds, "
                         f"CAST({ts} AS VARCHAR) AS event_ts_text FROM bronze"),
        "scalar_conditional": q(f"""SELECT event_id, coalesce(opponent_id, item_id, 'none') AS counterpart,
            CASE WHEN {t} IN ('kill', 'death') THEN 'combat' WHEN {t} = 'purchase' THEN 'commerce'
                 WHEN {t} IN ('login', 'logout') THEN 'presence' ELSE 'other' END AS category,
            CASE WHEN item_price_usd IS NULL THEN NULL WHEN item_price_usd >= 20 THEN 'high'
                 WHEN item_price_usd >= 5 THEN 'mid' ELSE 'low' END AS price_band,
            game_mode IS NULL AS mode_missing FROM cleaned"""),
        "scalar_math": q(f"""SELECT session_id, kd_ratio, kills - deaths AS net_kills, (kills + deaths) * 2 AS double_engagements,
            abs(kills - deaths) AS abs_net, kills % 7 AS kills_mod7, duration_min * 60.0::DOUBLE AS duration_s,
            CAST(experience_gain AS DOUBLE) / 100.0::DOUBLE AS xp_hundreds,
            {rr('kills', 'deaths + 1', 2)} AS kd_ratio_2dp FROM sessions"""),
        "null_fill": q("SELECT event_id, coalesce(weapon, 'none') AS weapon, coalesce(item_price_usd, 0.0::DOUBLE) AS item_price_usd, "
                       "coalesce(session_kills, 0) AS session_kills, coalesce(payment_method, 'unknown') AS payment_method FROM cleaned"),
        "dedup_events": q("SELECT event_id, player_id, event_ts, ingest_ts FROM deduped"),
        # K
        "arpu_features_daily": g("SELECT * FROM arpu"),
        "player_segments": g("SELECT * FROM segments"),
        "churn_overview": q(f"""SELECT count(*) AS players,
            {rr('sum(days_since_login)', 'count(days_since_login)', 2)} AS avg_days_since_login,
            {rr('sum(login_count_7d)', 'count(*)', 2)} AS avg_logins_7d,
            {rr('sum(' + units('total_playtime_7d', 3600) + ')', 'count(*) * 3600', 2)} AS avg_playtime_hours_7d,
            {rr(cents_sum('total_spend_30d'), 'count(*) * 100', 2)} AS avg_spend_30d,
            {rr('sum(churn_label)', 'count(*)', 4)} AS churn_rate FROM churn"""),
        "label_balance": q(f"""SELECT churn_label, count(*) AS players,
            {rr('sum(login_count_7d)', 'count(*)', 2)} AS avg_login_count_7d,
            {rr('sum(' + units('avg_session_duration_7d', 1_000_000) + ')', 'count(*) * 1000000', 2)} AS avg_session_duration_7d,
            {rr(cents_sum('total_spend_30d'), 'count(*) * 100', 2)} AS avg_total_spend_30d
            FROM churn GROUP BY churn_label"""),
        "tier_summary": g(f"""SELECT premium_tier, count(*) AS players,
            {rr(cents_sum('total_spend_90d'), 'count(*) * 100', 2)} AS avg_spend_90d,
            {rr('sum(purchase_frequency_30d)', 'count(*)', 2)} AS avg_purchases_30d FROM arpu GROUP BY premium_tier"""),
        "segment_matrix": g("SELECT engagement_segment, revenue_segment, count(*) AS players FROM segments GROUP BY ALL"),
        "churn_point_in_time": _pit_sql(),
        # L / M
        "ml_features": q("""SELECT player_id, churn_label, coalesce(platform_primary, 'Unknown') AS platform_primary,
            coalesce(region_primary, 'Unknown') AS region_primary, coalesce(days_since_login, 0) AS days_since_login,
            login_count_7d, login_count_30d, avg_session_duration_7d, total_playtime_7d, kill_count_7d,
            match_count_7d, win_rate_7d, avg_spend_7d, avg_spend_30d, total_spend_30d, compute_date FROM churn"""),
        "ml_split": q("SELECT player_id, churn_label, CAST('0x' || substr(md5(player_id || ':42'), 1, 8) AS BIGINT) "
                      "% 100 < 70 AS is_train FROM churn"),
        "risk_tier": g("SELECT player_id, compute_date, churn_probability, risk_tier, days_since_login, login_count_7d, "
                       "total_spend_30d, platform_primary, region_primary FROM scored"),
        "risk_summary": g(f"""SELECT risk_tier, count(*) AS players,
            {rr('sum(' + units('churn_probability', 1_000_000) + ')', 'count(churn_probability) * 1000000', 4)} AS avg_churn_probability,
            {rr(cents_sum('total_spend_30d'), 'count(*) * 100', 2)} AS avg_spend_30d FROM scored GROUP BY risk_tier"""),
        "vw_retention_churn": g("SELECT * FROM vw_ret", VIEW_RET),
        "vw_player_segments": g(f"""SELECT compute_date, region_primary AS region, platform_primary AS platform,
            engagement_segment, revenue_segment, count(*) AS players,
            {rr('sum(' + units('avg_session_duration_7d', 1_000_000) + ')', 'count(avg_session_duration_7d) * 1000000', 6)} AS avg_session_duration_7d,
            {rr('sum(' + units('win_rate_7d', 1_000_000) + ')', 'count(win_rate_7d) * 1000000', 6)} AS avg_win_rate_7d
            FROM segments GROUP BY ALL"""),
        "vw_arpu_summary": g("SELECT * FROM vw_arpu", VIEW_ARPU),
        "bi_measures": g(f"""SELECT CAST(r.players AS BIGINT) AS players,
            {rr('r.pv', 'r.npv * 1000000', 4)} AS avg_churn_probability,
            {rr('r.pw', 'r.npw * 1000000', 4)} AS weighted_churn_probability,
            CAST(r.high_risk_players AS BIGINT) AS high_risk_players,
            {rr('r.high_risk_players', 'r.players', 4)} AS high_risk_share,
            {rr('a.av', 'a.nav * 1000000', 4)} AS arpu_30d
            FROM (SELECT sum(players) AS players, sum({units('avg_churn_probability', 1_000_000)}) AS pv,
                         count(avg_churn_probability) AS npv,
                         sum(players * {units('avg_churn_probability', 1_000_000)}) AS pw,
                         sum(CASE WHEN avg_churn_probability IS NOT NULL THEN players END) AS npw,
                         sum(CASE WHEN risk_tier = 'high' THEN players ELSE 0 END) AS high_risk_players FROM vw_ret) r,
                 (SELECT sum({units('avg_spend_30d', 1_000_000)}) AS av, count(avg_spend_30d) AS nav FROM vw_arpu) a""",
                         VIEW_RET, VIEW_ARPU),
        **oracle_sql_more(),
        **oracle_sql_raw(),
        **oracle_sql_tables(),
        "action_list": g("SELECT player_id, compute_date, churn_probability, days_since_login, login_count_7d, "
                         "total_spend_30d, platform_primary, region_primary FROM scored WHERE risk_tier = 'high' "
                         "ORDER BY total_spend_30d DESC, player_id ASC LIMIT 20"),
    }


def _hist_cte(start: str = FIRST_DAY, end: str = AS_OF) -> str:
    def w(days, col):
        return f"({col} >= c - INTERVAL {days} DAY AND {col} <= c)"
    return f"""
cal AS (SELECT CAST(unnest(generate_series({start}, {end}, INTERVAL 1 DAY)) AS DATE) AS c),
h_act AS (
  SELECT player_id, c,
    min(event_date) FILTER (WHERE event_date <= c) AS first_seen_date,
    max(event_date) FILTER (WHERE event_type_normalized = 'login' AND event_date <= c) AS last_login_date,
    count(*) FILTER (WHERE event_type_normalized = 'login' AND {w(7, 'event_date')}) AS login_count_7d,
    count(*) FILTER (WHERE event_type_normalized = 'login' AND {w(30, 'event_date')}) AS login_count_30d,
    count(*) FILTER (WHERE event_type_normalized = 'kill' AND {w(7, 'event_date')}) AS kill_count_7d,
    count(*) FILTER (WHERE {w(7, 'event_date')}) AS event_count_7d
  FROM cleaned CROSS JOIN cal GROUP BY player_id, c
  HAVING count(*) FILTER (WHERE event_date <= c OR event_date IS NULL) > 0),
h_plat AS (
  SELECT player_id, c, platform AS platform_primary FROM (
    SELECT player_id, c, platform, row_number() OVER (PARTITION BY player_id, c ORDER BY n DESC, platform) AS rn
    FROM (SELECT player_id, c, platform, count(*) AS n FROM cleaned CROSS JOIN cal
          WHERE platform IS NOT NULL AND (event_date <= c OR event_date IS NULL)
          GROUP BY player_id, c, platform)) WHERE rn = 1),
h_reg AS (
  SELECT player_id, c, region AS region_primary FROM (
    SELECT player_id, c, region, row_number() OVER (PARTITION BY player_id, c ORDER BY n DESC, region) AS rn
    FROM (SELECT player_id, c, region, count(*) AS n FROM cleaned CROSS JOIN cal
          WHERE region IS NOT NULL AND (event_date <= c OR event_date IS NULL)
          GROUP BY player_id, c, region)) WHERE rn = 1),
h_ses AS (
  SELECT player_id, c,
    count(*) FILTER (WHERE {w(7, 'session_date')}) AS match_count_7d,
    count(duration_min) FILTER (WHERE {w(7, 'session_date')}) AS n_dur7,
    sum(CAST(floor(duration_min * 60.0 + 0.5) AS BIGINT)) FILTER (WHERE {w(7, 'session_date')}) AS sec7,
    count(matches_won) FILTER (WHERE {w(7, 'session_date')}) AS n_won7,
    sum(matches_won) FILTER (WHERE {w(7, 'session_date')}) AS won7
  FROM sessions CROSS JOIN cal GROUP BY player_id, c),
h_spend AS (
  SELECT player_id, c,
    sum(CAST(item_price_usd AS DECIMAL(18,2))) FILTER (WHERE {w(7, 'event_date')}) AS spend7,
    sum(CAST(item_price_usd AS DECIMAL(18,2))) FILTER (WHERE {w(30, 'event_date')}) AS spend30
  FROM purchases CROSS JOIN cal GROUP BY player_id, c),
hist AS (
  SELECT a.player_id, a.c AS compute_date, a.first_seen_date, a.last_login_date,
    a.login_count_7d, a.login_count_30d, a.kill_count_7d, a.event_count_7d,
    p.platform_primary, r.region_primary,
    coalesce(s.match_count_7d, 0) AS match_count_7d,
    coalesce(CASE WHEN s.n_dur7 * 60 <> 0 THEN CAST(s.sec7 AS DOUBLE) / CAST(s.n_dur7 * 60 AS DOUBLE) END, 0.0) AS avg_session_duration_7d,
    CAST(coalesce(s.sec7, 0) AS DOUBLE) / 3600.0::DOUBLE AS total_playtime_7d,
    coalesce(CASE WHEN s.n_won7 <> 0 THEN CAST(s.won7 AS DOUBLE) / CAST(s.n_won7 AS DOUBLE) END, 0.0) AS win_rate_7d,
    CAST(coalesce(sp.spend7, 0) AS DOUBLE) / 7.0::DOUBLE AS avg_spend_7d,
    CAST(coalesce(sp.spend30, 0) AS DOUBLE) / 30.0::DOUBLE AS avg_spend_30d,
    CAST(coalesce(sp.spend30, 0) AS DOUBLE) AS total_spend_30d,
    CAST(date_diff('day', a.last_login_date, a.c) AS INTEGER) AS days_since_login,
    date_diff('day', a.first_seen_date, a.c) < 30 AS is_new_player,
    CAST(CASE WHEN date_diff('day', a.last_login_date, a.c) >= 7 THEN 1 ELSE 0 END AS INTEGER) AS churn_label
  FROM h_act a
  LEFT JOIN h_plat p USING (player_id, c)
  LEFT JOIN h_reg r USING (player_id, c)
  LEFT JOIN h_ses s USING (player_id, c)
  LEFT JOIN h_spend sp USING (player_id, c))"""


LOGIN_SESSIONS = """
ls_ev AS (
  SELECT player_id, event_id, event_ts, game_mode, region, platform, item_price_usd, experience_granted,
    session_kills, session_deaths, event_type_normalized AS t,
    CASE WHEN event_type_normalized = 'login' THEN 1 ELSE 0 END AS is_in,
    CASE WHEN event_type_normalized = 'logout' THEN 1 ELSE 0 END AS is_out
  FROM cleaned WHERE event_ts IS NOT NULL),
ls_w AS (
  SELECT *,
    sum(is_in) OVER (PARTITION BY player_id ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sess_no,
    coalesce(sum(is_out) OVER (PARTITION BY player_id ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o_excl
  FROM ls_ev),
ls_s AS (
  SELECT *,
    first_value(o_excl) OVER s AS o_login, first_value(event_ts) OVER s AS login_ts,
    first_value(event_id) OVER s AS login_id, first_value(region) OVER s AS login_region,
    first_value(platform) OVER s AS login_platform
  FROM ls_w WHERE sess_no > 0
  WINDOW s AS (PARTITION BY player_id, sess_no ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ls_in AS (SELECT * FROM ls_s WHERE o_excl = o_login),
ls_mode AS (
  SELECT player_id, sess_no, game_mode FROM (
    SELECT player_id, sess_no, game_mode, row_number() OVER (PARTITION BY player_id, sess_no ORDER BY n DESC, game_mode) AS rn
    FROM (SELECT player_id, sess_no, game_mode, count(*) AS n FROM ls_in WHERE game_mode IS NOT NULL
          GROUP BY player_id, sess_no, game_mode)) WHERE rn = 1),
ls_agg AS (
  SELECT player_id, sess_no, any_value(login_ts) AS login_ts, any_value(login_id) AS login_id,
    min(event_ts) FILTER (WHERE is_out = 1) AS logout_ts,
    any_value(login_region) AS region, any_value(login_platform) AS platform,
    CAST(count(*) FILTER (WHERE t = 'kill') AS INTEGER) AS kills,
    CAST(count(*) FILTER (WHERE t = 'death') AS INTEGER) AS deaths,
    CAST(count(*) FILTER (WHERE t = 'session_end') AS INTEGER) AS matches_played,
    CAST(count(*) FILTER (WHERE t = 'session_end' AND coalesce(session_kills, 0) >= coalesce(session_deaths, 0)) AS INTEGER) AS matches_won,
    CAST(count(*) FILTER (WHERE t = 'purchase') AS INTEGER) AS items_purchased,
    CAST(coalesce(sum(CAST(item_price_usd AS DECIMAL(18,2))) FILTER (WHERE t = 'purchase' AND item_price_usd >= 0), 0) AS DOUBLE) AS spent_usd,
    CAST(coalesce(sum(experience_granted) FILTER (WHERE t = 'kill'), 0) AS BIGINT) AS experience_gain
  FROM ls_in GROUP BY player_id, sess_no),
login_sessions AS (
  SELECT sha256(concat_ws(':', a.player_id, CAST(login_ts AS VARCHAR), login_id)) AS session_id,
    a.player_id, login_ts, logout_ts,
    CAST(epoch_us(logout_ts) - epoch_us(login_ts) AS DOUBLE) / 60000000.0::DOUBLE AS duration_min,
    m.game_mode, region, platform, kills, deaths,
    CAST(kills AS DOUBLE) / CAST(deaths + 1 AS DOUBLE) AS kd_ratio,
    matches_played, matches_won,
    CASE WHEN matches_played > 0 THEN CAST(matches_won AS DOUBLE) / CAST(matches_played AS DOUBLE) END AS win_rate,
    items_purchased, spent_usd, experience_gain
  FROM ls_agg a LEFT JOIN ls_mode m USING (player_id, sess_no))"""

PAIRS = """
pairs AS (SELECT player_id, event_date AS day, count(*) AS events FROM cleaned
          WHERE event_date IS NOT NULL GROUP BY player_id, event_date)"""


def oracle_sql_more() -> dict[str, str]:
    t = "event_type_normalized"
    valid = f"{t} = 'purchase' AND item_price_usd >= 0 AND item_price_usd < 1e16"
    rev = f"coalesce(sum(CAST(item_price_usd AS DECIMAL(18,2))) FILTER (WHERE {valid}), 0)"
    return {
        "churn_history": q("SELECT * FROM hist", _hist_cte()),
        "latest_snapshot": q("SELECT * FROM hist WHERE compute_date = (SELECT max(compute_date) FROM hist)", _hist_cte()),
        "login_sessions": q("SELECT * FROM login_sessions", LOGIN_SESSIONS),
        "dau": q("SELECT day AS activity_date, count(*) AS dau, CAST(sum(events) AS BIGINT) AS events "
                 "FROM pairs GROUP BY day", PAIRS),
        "rolling_active": q("""SELECT r.activity_date,
              count(p.player_id) FILTER (WHERE p.day = r.activity_date) AS dau,
              count(DISTINCT p.player_id) FILTER (WHERE p.day > r.activity_date - INTERVAL 7 DAY) AS active_7d,
              count(DISTINCT p.player_id) AS active_30d,
              CAST(count(p.player_id) FILTER (WHERE p.day > r.activity_date - INTERVAL 7 DAY) AS DOUBLE) / 7.0::DOUBLE AS mean_dau_7d
            FROM rcal r LEFT JOIN pairs p ON p.day <= r.activity_date AND p.day > r.activity_date - INTERVAL 30 DAY
            GROUP BY r.activity_date""", PAIRS,
                            "rcal AS (SELECT CAST(unnest(generate_series((SELECT min(day) FROM pairs), "
                            "(SELECT max(day) FROM pairs), INTERVAL 1 DAY)) AS DATE) AS activity_date)"),
        "retention_curve": q(f"""SELECT g.cohort_date, g.day_n, g.cohort_size, coalesce(c.retained, 0) AS retained,
              {rr('coalesce(c.retained, 0)', 'g.cohort_size', 4)} AS retention_rate
            FROM grid g LEFT JOIN cnt c USING (cohort_date, day_n)""", PAIRS,
            "firsts AS (SELECT player_id, min(day) AS cohort_date FROM pairs GROUP BY player_id)",
            "sizes AS (SELECT cohort_date, count(*) AS cohort_size FROM firsts GROUP BY cohort_date)",
            "grid AS (SELECT cohort_date, cohort_size, CAST(unnest(range(0, date_diff('day', cohort_date, "
            "(SELECT max(day) FROM pairs)) + 1)) AS INTEGER) AS day_n FROM sizes)",
            "cnt AS (SELECT f.cohort_date, CAST(date_diff('day', f.cohort_date, p.day) AS INTEGER) AS day_n, "
            "count(*) AS retained FROM pairs p JOIN firsts f USING (player_id) GROUP BY ALL)"),
        "arpu_by_region": q(f"""SELECT region, CAST({rev} AS DOUBLE) AS revenue_usd,
              count(DISTINCT player_id) AS active_players,
              count(DISTINCT player_id) FILTER (WHERE {valid}) AS paying_players,
              {ediv(rev, 'count(DISTINCT player_id)')} AS arpu,
              {ediv(rev, f'count(DISTINCT player_id) FILTER (WHERE {valid})')} AS arppu
            FROM cleaned GROUP BY region"""),
        "spend_distribution": q(f"""SELECT spend_bucket, players, CAST(rev AS DOUBLE) AS revenue_usd,
              {rr('players', 'sum(players) OVER ()', 4)} AS player_share,
              {rr('rev * 100', 'sum(rev) OVER () * 100', 4)} AS revenue_share
            FROM (SELECT CASE WHEN total_spend_30d <= 0 THEN 'free' WHEN total_spend_30d < 20 THEN 'low'
                              WHEN total_spend_30d < 100 THEN 'mid' ELSE 'whale' END AS spend_bucket,
                         count(*) AS players, {msum('total_spend_30d')} AS rev
                  FROM churn GROUP BY 1)"""),
        "spend_percentiles": q(" UNION ALL ".join(
                                   f"SELECT {p}::DOUBLE AS percentile, quantile_disc(total_spend_30d, {p}) AS spend_30d FROM churn"
                                   for p in (0.5, 0.75, 0.9, 0.95, 0.99))),
        "ltv_by_cohort": q(f"""SELECT CAST(date_trunc('month', f) AS DATE) AS cohort_month, count(*) AS players,
              count(*) FILTER (WHERE n > 0) AS payers, CAST(coalesce(sum(rev), 0) AS DOUBLE) AS revenue_usd,
              {ediv('coalesce(sum(rev), 0)', 'count(*)')} AS ltv_usd
            FROM (SELECT player_id, min(event_date) AS f, {msum('item_price_usd')} FILTER (WHERE {valid}) AS rev,
                         count(*) FILTER (WHERE {valid}) AS n FROM cleaned WHERE event_date IS NOT NULL GROUP BY 1)
            GROUP BY 1"""),
        "session_count_dist": q(f"""SELECT sessions AS sessions_per_player, count(*) AS players,
              {ediv('sum(sec)', 'sum(sessions) * 60')} AS avg_session_min
            FROM (SELECT player_id, count(*) AS sessions, sum({units('duration_min', 60)}) AS sec
                  FROM sessions GROUP BY player_id) GROUP BY sessions"""),
        "platform_region": q("SELECT platform, region, count(*) AS events, count(DISTINCT player_id) AS players "
                             "FROM cleaned GROUP BY platform, region"),
        "win_rate_by_tier": q(f"""SELECT CASE WHEN kd <= q1 THEN 1 WHEN kd <= q2 THEN 2 WHEN kd <= q3 THEN 3 ELSE 4 END AS skill_tier,
              count(*) AS players, CAST(sum(sessions) AS BIGINT) AS sessions, min(kd) AS min_kd, max(kd) AS max_kd,
              {rr('sum(won)', 'sum(sessions)', 4)} AS win_rate
            FROM per, (SELECT quantile_disc(kd, 0.25) AS q1, quantile_disc(kd, 0.5) AS q2,
                              quantile_disc(kd, 0.75) AS q3 FROM per) GROUP BY 1""",
                              "per AS (SELECT player_id, count(*) AS sessions, sum(matches_won) AS won, "
                              "CAST(sum(kills) AS DOUBLE) / CAST(sum(deaths) + 1 AS DOUBLE) AS kd FROM sessions GROUP BY player_id)"),
    }


def oracle_sql_tables() -> dict[str, str]:
    """Round trips through files, streams and the catalog give back the tables; and the ML inputs."""
    from respawn.constants import CATEGORICAL_COLUMNS, FEATURE_COLUMNS
    kept = ("event_id, player_id, event_type_normalized, event_ts, game_mode, region, platform, payload, event_date, "
            "opponent_id, weapon, headshot, item_id, item_name, item_price_usd, payment_method, experience_granted, "
            "session_duration_seconds, session_kills, session_deaths, session_xp, session_items_purchased")
    quality = " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS total, count(*) FILTER (WHERE NOT coalesce(({p}), false)) AS failed FROM raw"
        for name, _, p in RULES["raw_events"][1]) + " UNION ALL SELECT 'well_formed', count(*), 0 FROM raw"
    slots = [f"CAST(coalesce({c}, 0) AS DOUBLE) AS f{i}" for i, c in enumerate(FEATURE_COLUMNS)]
    slots += [f"CAST({c}_i AS DOUBLE) AS f{len(FEATURE_COLUMNS) + i}" for i, c in enumerate(CATEGORICAL_COLUMNS)]
    index = [f"ix_{c} AS (SELECT v AS {c}_v, row_number() OVER (ORDER BY n DESC, v) - 1 AS {c}_i FROM "
             f"(SELECT coalesce({c}, 'Unknown') AS v, count(*) AS n FROM churn GROUP BY 1))" for c in CATEGORICAL_COLUMNS]
    joins = " ".join(f"JOIN ix_{c} ON coalesce({c}, 'Unknown') = {c}_v" for c in CATEGORICAL_COLUMNS)
    return {
        "csv_round_trip": q("SELECT * FROM raw"),
        "stream_bronze": q("SELECT * FROM bronze"),
        "stream_clean_events": q(f"SELECT {kept} FROM cleaned"),
        "ingest_quality": q(f"SELECT rule, CAST(total AS BIGINT) AS total, CAST(failed AS BIGINT) AS failed FROM ({quality})"),
        "expect_or_fail": q("SELECT event_type, count(*) AS events FROM bronze GROUP BY event_type"),
        "catalog_tables": q("SELECT * FROM purchases"),
        "preview": q("SELECT event_id, player_id, event_ts, opponent_id, weapon, headshot, experience_granted FROM cleaned "
                     "WHERE event_type_normalized = 'kill' ORDER BY event_ts NULLS FIRST, event_id NULLS FIRST LIMIT 50"),
        "ml_vectors": q(f"SELECT player_id, {', '.join(slots)} FROM churn {joins}", *index),
        "prediction_review": g("""SELECT c.player_id, c.churn_label, CASE WHEN s.churn_probability >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
              s.churn_probability FROM churn c JOIN scores s USING (player_id)"""),
        "declared_view": q("SELECT region, count(*) AS purchases FROM purchases WHERE item_price_usd >= 10 GROUP BY region"),
        "score_quality": g(f"""SELECT tp, fp, tn, fn, {ediv('tp + tn', 'tp + fp + tn + fn')} AS accuracy,
              {ediv('tp * 2', 'tp * 2 + fp + fn')} AS f1,
              (SELECT {ediv('sum(ahead)', '2 * count(*)')} FROM (
                 SELECT CASE WHEN a.churn_probability > b.churn_probability THEN 2 WHEN a.churn_probability = b.churn_probability THEN 1 ELSE 0 END AS ahead
                 FROM (SELECT s.churn_probability FROM churn c JOIN scores s USING (player_id) WHERE churn_label = 1) a,
                      (SELECT s.churn_probability FROM churn c JOIN scores s USING (player_id) WHERE churn_label = 0) b)) AS auc
            FROM (SELECT count(*) FILTER (WHERE y = 1 AND p) AS tp, count(*) FILTER (WHERE y = 0 AND p) AS fp,
                         count(*) FILTER (WHERE y = 0 AND NOT p) AS tn, count(*) FILTER (WHERE y = 1 AND NOT p) AS fn
                  FROM (SELECT c.churn_label AS y, s.churn_probability >= 0.5 AS p
                        FROM churn c JOIN scores s USING (player_id)))"""),
    }


def oracle_sql_raw() -> dict[str, str]:
    summary = """
SELECT 'total' AS dimension, 'rows' AS value, count(*) AS events FROM raw
UNION ALL SELECT 'total', 'players', count(DISTINCT player_id) FROM raw
UNION ALL SELECT 'event_type', event_type, count(*) FROM raw GROUP BY event_type
UNION ALL SELECT 'region', region, count(*) FROM raw GROUP BY region
UNION ALL SELECT 'platform', platform, count(*) FROM raw GROUP BY platform
UNION ALL SELECT 'day', substr("timestamp", 1, 10), count(*) FROM raw GROUP BY substr("timestamp", 1, 10)"""
    return {"gen_summary": "WITH " + RAW + summary}
