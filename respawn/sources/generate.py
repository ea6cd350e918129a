"""Synthetic raw-event generation as a distributed Spark job.

Each input row (a seed id) becomes one raw event. Every random choice is a
pure function of (seed, id, attribute) -- the first 32 bits of an MD5 digest
-- so generation is deterministic, needs no driver-side state and runs in
parallel on any number of executors (re-running a lost task reproduces the
same rows). Value domains and ranges follow the telemetry contract.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respawn.constants import (EVENT_TYPES, GAME_MODES, GENERATOR_DAYS, GENERATOR_PLAYERS,
                               ITEM_PRICES_USD, LOGOUT_REASONS, PAYMENT_METHODS, PLATFORMS,
                               RAW_COLUMNS, REGIONS, SKINS, WEAPONS)
from respawn.sources.driver import IP_COUNTRIES, _json, _pick, _q


def _digest(seed: int, salt: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"), F.lit(f":{salt}")))


def _rand(seed: int, salt: str) -> Column:
    """Uniform integer in [0, 2^32) derived from (seed, id, salt)."""
    return F.conv(F.substring(_digest(seed, salt), 1, 8), 16, 10).cast("long")


def _uuid(seed: int, salt: str) -> Column:
    h = _digest(seed, salt)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def _player(seed: int, idx: Column) -> Column:
    return F.concat(F.lit("player_"), F.substring(
        F.md5(F.concat(F.lit(f"{seed}:player:"), idx.cast("string"))), 1, 12))


TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def generate_events(seeds: DataFrame, n_players: int = GENERATOR_PLAYERS, days_back: int = GENERATOR_DAYS,
                    end: str = "2024-01-31 00:00:00", seed: int = 42) -> DataFrame:
    """One raw event (10 string columns, CSV-ready) per row of ``seeds(id bigint)``."""
    r = lambda salt: _rand(seed, salt)
    end_us = int(dt.datetime.fromisoformat(end).replace(tzinfo=dt.timezone.utc).timestamp() * 1_000_000)
    span_us = days_back * 86_400 * 1_000_000
    ts = F.timestamp_micros(F.lit(end_us) - F.pmod(r("ts") * F.lit(1_000_003), F.lit(span_us)))
    lag = F.lit(1) + F.pmod(r("lag"), F.lit(10))
    et = F.col("event_type")
    skin_idx = F.pmod(r("skin"), F.lit(5))
    item_names = [s.replace("_", " ").title() + " Skin" for s in SKINS]
    weapon = _pick(WEAPONS, F.pmod(r("weapon"), F.lit(5)))
    other = _player(seed, F.pmod(r("other"), F.lit(n_players)))
    payload = (
        F.when(et == "login", _json(("session_token", _q(_uuid(seed, "token"))),
                                    ("ip_country", _q(_pick(IP_COUNTRIES, F.pmod(r("country"), F.lit(4)))))))
        .when(et == "kill", _json(("opponent_id", _q(other)), ("weapon", _q(weapon)),
                                  ("headshot", F.when(F.pmod(r("hs"), F.lit(2)) == 0, F.lit("true")).otherwise(F.lit("false"))),
                                  ("experience_granted", (F.lit(50) + F.pmod(r("xp"), F.lit(151))).cast("string"))))
        .when(et == "death", _json(("killed_by", _q(other)), ("weapon", _q(weapon)),
                                   ("distance_m", (F.lit(5) + F.pmod(r("dist"), F.lit(496))).cast("string"))))
        .when(et == "purchase", _json(
            ("item_id", _q(F.concat(F.lit("skin_"), _pick(SKINS, skin_idx)))),
            ("item_name", _q(_pick(item_names, skin_idx))),
            ("item_price_usd", _pick(ITEM_PRICES_USD, F.pmod(r("price"), F.lit(4)))),
            ("currency", _q(F.lit("USD"))),
            ("payment_method", _q(_pick(PAYMENT_METHODS, F.pmod(r("pay"), F.lit(4)))))))
        .when(et == "session_end", _json(
            ("total_kills", F.pmod(r("k"), F.lit(101)).cast("string")),
            ("total_deaths", F.pmod(r("d"), F.lit(51)).cast("string")),
            ("total_earned_xp", (F.lit(100) + F.pmod(r("sxp"), F.lit(9901))).cast("string")),
            ("duration_seconds", (F.lit(300) + F.pmod(r("dur"), F.lit(6901))).cast("string")),
            ("items_purchased", F.pmod(r("items"), F.lit(6)).cast("string"))))
        .otherwise(_json(("reason", _q(_pick(LOGOUT_REASONS, F.pmod(r("reason"), F.lit(3))))))))
    typed = seeds.select(
        "id", _pick(EVENT_TYPES, F.pmod(r("type"), F.lit(6))).alias("event_type"), ts.alias("_ts"))
    return typed.select(
        _uuid(seed, "event").alias("event_id"),
        _player(seed, F.pmod(r("player"), F.lit(n_players))).alias("player_id"),
        "event_type",
        F.date_format("_ts", TS_FORMAT).alias("timestamp"),
        F.when(et == "logout", F.lit(None).cast("string"))
        .otherwise(_pick(GAME_MODES, F.pmod(r("mode"), F.lit(4)))).alias("game_mode"),
        _pick(REGIONS, F.pmod(r("region"), F.lit(4))).alias("region"),
        _pick(PLATFORMS, F.pmod(r("platform"), F.lit(3))).alias("platform"),
        payload.alias("payload"),
        F.date_format(F.col("_ts") + F.make_interval(secs=lag.cast("int")), TS_FORMAT).alias("ingest_ts"),
        F.to_date("_ts").cast("string").alias("ingest_date"),
    ).select(*RAW_COLUMNS)


def generation_summary(raw: DataFrame) -> DataFrame:
    """Rows, players, and counts per event type / region / platform / day, long format
    (dimension, value, events); one pass with per-dimension grouping sets."""
    df = raw.select("player_id", "event_type", "region", "platform",
                    F.substring("timestamp", 1, 10).alias("day"))
    parts = [df.agg(F.lit("total").alias("dimension"), F.lit("rows").alias("value"),
                    F.count(F.lit(1)).alias("events")),
             df.agg(F.lit("total").alias("dimension"), F.lit("players").alias("value"),
                    F.count_distinct("player_id").alias("events"))]
    for dim in ("event_type", "region", "platform", "day"):
        parts.append(df.groupBy(F.col(dim).alias("value")).agg(F.count(F.lit(1)).alias("events"))
                     .select(F.lit(dim).alias("dimension"), "value", "events"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
