"""Adapter from the shared benchmark tables to the raw telemetry envelope.

The benchmark ``events`` table (event_id, ts, user_id, event_type, value,
props '{"k": n}') is mapped, row by row and with built-in functions only, onto
the ten-string-column raw event envelope the bronze layer ingests. The mapping
is a pure projection plus one ``explode`` (duplicate delivery), so it is a
narrow, partition-local stage that scales with the input; nothing is
collected. A deterministic share of rows is made dirty so that every
data-quality rule, the normaliser and the de-duplicator have work to do:

* every 50th event id is delivered twice, the copy ingested one hour later;
* every 7th event id carries mixed-case / padded region, platform and mode;
* every 101st has no player id, every 103rd no event id;
* every 97th has an unknown event type;
* every 89th has a truncated (malformed) JSON payload;
* every 211th has an unparsable timestamp.

The same rules are written in SQL in ``respawn.plans.oracle`` for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from respawn.constants import (GAME_MODES, LOGOUT_REASONS, PAYMENT_METHODS,
                               PLATFORMS, RAW_COLUMNS, REGIONS, SKINS, WEAPONS)

# Fixed values of the adapter itself (not part of the telemetry contract).
IP_COUNTRIES = ["US", "DE", "JP", "BR"]
# Benchmark event type -> telemetry event type ('view' splits into logout / session_end).
TYPE_MAP = {"signup": "login", "click": "kill", "error": "death", "purchase": "purchase"}

#: A length that no text reaches.
WHOLE = (1 << 31) - 1

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Session setting: into how many tasks to deal the events before the adapter. Unset (the default)
#: leaves the scan's splits as they are; a single-row-group file is otherwise read by one task.
SPREAD = "spark.respawn.adapterPartitions"


def spread(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows out by ``key`` if the session asks for it (see ``SPREAD``)."""
    wanted = df.sparkSession.conf.get(SPREAD, "")
    return df.repartition(int(wanted), key) if wanted else df


def _pick(values: list[str], idx: Column) -> Column:
    """values[idx] for a 0-based integer index column; the last value where the index is null."""
    return F.get(F.array(*[F.lit(v) for v in values]), F.coalesce(idx, F.lit(len(values) - 1)).cast("int"))


def _q(c: Column) -> list:
    return ['"', c, '"']


def _json(*pairs) -> Column:
    """'{"a": v, "b": w}' with the separators of a default JSON dump; neighbouring literals are joined, so the generated code stays small."""
    parts: list = []
    for i, (k, v) in enumerate(pairs):
        parts += [("{" if i == 0 else ", ") + f'"{k}": ', *(v if isinstance(v, list) else [v])]
    joined: list = []
    for part in [*parts, "}"]:
        if isinstance(part, str) and joined and isinstance(joined[-1], str):
            joined[-1] += part
        else:
            joined.append(part)
    return F.concat(*(F.lit(part) if isinstance(part, str) else part for part in joined))


def raw_events_from_driver(events: DataFrame) -> DataFrame:
    """Benchmark ``events`` rows -> raw bronze envelope (all strings)."""
    e = F.col("event_id")
    src = F.col("event_type")
    etype = F.when(src == "view", F.when(F.pmod(e, F.lit(4)) == 0, F.lit("logout"))
                   .otherwise(F.lit("session_end")))
    for s, d in TYPE_MAP.items():
        etype = etype.when(src == s, F.lit(d))
    etype = etype.otherwise(src)
    base = events.select(
        e.alias("e"), F.col("user_id").alias("u"), F.col("ts"), etype.alias("etype"),
        F.get_json_object("props", "$.k").try_cast("long").alias("k"), F.col("value"),
    )
    return _envelope(base)


def _envelope(base: DataFrame) -> DataFrame:
    e, u, k = F.col("e"), F.col("u"), F.col("k")
    et = F.col("etype")
    dim_key = F.when(F.pmod(e, F.lit(5)) == 0, e).otherwise(u)
    messy = F.pmod(e, F.lit(7)) == 0
    cents = F.floor(F.col("value") * F.lit(20)).cast("long")
    price_txt = F.format_string("%d.%02d", ((cents - F.pmod(cents, F.lit(100))) / 100).cast("long"),
                                F.pmod(cents, F.lit(100)))
    skin = _pick(SKINS, F.pmod(k, F.lit(5)))
    item_names = [s.replace("_", " ").title() + " Skin" for s in SKINS]
    weapon = _pick(WEAPONS, F.pmod(k, F.lit(5)))
    other = ['"player_', (u + k).cast("string"), '"']

    payload = (
        F.when(et == "login", _json(
            ("session_token", _q(F.md5(e.cast("string")))),
            ("ip_country", _q(_pick(IP_COUNTRIES, F.pmod(u, F.lit(4))))),
        ))
        .when(et == "kill", _json(
            ("opponent_id", other),
            ("weapon", _q(weapon)),
            ("headshot", F.when(F.pmod(k, F.lit(2)) == 0, F.lit("true")).otherwise(F.lit("false"))),
            ("experience_granted", (F.lit(50) + k).cast("string")),
        ))
        .when(et == "death", _json(
            ("killed_by", other),
            ("weapon", _q(weapon)),
            ("distance_m", (F.lit(5) + k).cast("string")),
        ))
        .when(et == "purchase", _json(
            ("item_id", ['"skin_', skin, '"']),
            ("item_name", _q(_pick(item_names, F.pmod(k, F.lit(5))))),
            ("item_price_usd", price_txt),
            ("currency", _q(F.lit("USD"))),
            ("payment_method", _q(_pick(PAYMENT_METHODS, F.pmod(e, F.lit(4))))),
        ))
        .when(et == "session_end", _json(
            ("total_kills", k.cast("string")),
            ("total_deaths", F.pmod(e, F.lit(51)).cast("string")),
            ("total_earned_xp", (F.lit(100) + F.lit(100) * k).cast("string")),
            ("duration_seconds", (F.lit(300) + F.pmod(e, F.lit(6901))).cast("string")),
            ("items_purchased", F.pmod(k, F.lit(6)).cast("string")),
        ))
        .otherwise(_json(("reason", _q(_pick(LOGOUT_REASONS, F.pmod(e, F.lit(3)))))))
    )
    # one copy of each expression: a projection of more than 8,000 bytes of code is never compiled by the JVM
    payload = F.substring(payload, F.lit(1), F.when(F.pmod(e, F.lit(89)) == 0, 12).otherwise(WHOLE))

    def dirty(values: list[str], idx: Column, spoil) -> Column:
        """A value, spoilt in messy rows (one list of both)."""
        idx = F.coalesce(idx, F.lit(len(values) - 1))
        return _pick(values + [spoil(v) for v in values], idx + F.when(messy, F.lit(len(values))).otherwise(0))

    region = dirty(REGIONS, F.pmod(dim_key, F.lit(4)), str.lower)
    platform = dirty(PLATFORMS, F.pmod(dim_key, F.lit(3)), lambda v: f" {v.lower()} ")
    mode = dirty(GAME_MODES, F.pmod(e, F.lit(4)), lambda v: f" {v} ")

    # Duplicate delivery: copy 1 of every 50th event arrives an hour later.
    copies = F.explode(F.when(F.pmod(e, F.lit(50)) == 0, F.array(F.lit(0), F.lit(1)))
                       .otherwise(F.array(F.lit(0))))
    lag_s = F.pmod(e, F.lit(10)) + F.lit(1) + F.col("copy") * F.lit(3600)

    out = base.select("*", copies.alias("copy")).select(
        F.when(F.pmod(e, F.lit(103)) != 0, e.cast("string")).alias("event_id"),
        F.when(F.pmod(e, F.lit(101)) != 0, F.concat(F.lit("player_"), u.cast("string"))).alias("player_id"),
        F.when(F.pmod(e, F.lit(97)) == 0, F.lit("unknown")).otherwise(et).alias("event_type"),
        F.when(F.pmod(e, F.lit(211)) == 0, F.lit("not-a-time"))
         .otherwise(F.col("ts").cast("string")).alias("timestamp"),
        F.when(et == "logout", F.lit(None).cast("string")).otherwise(mode).alias("game_mode"),
        region.alias("region"),
        platform.alias("platform"),
        payload.alias("payload"),
        (F.col("ts") + F.make_interval(secs=lag_s.cast("int"))).cast("string").alias("ingest_ts"),
        F.to_date(F.col("ts")).cast("string").alias("ingest_date"),
    )
    return out.select(*RAW_COLUMNS)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw bronze envelope built from ``{sf_dir}/events.parquet``."""
    return raw_events_from_driver(spread(read_table(spark, sf_dir, "events"), "event_id"))
