"""Data profiles and quality summaries.

Each is a single aggregate (global or grouped): map-side partial aggregation
and one small shuffle; exact distinct counts use Spark's Expand-based distinct
aggregation (``approx=True`` switches to HyperLogLog++ sketches, which merge
map-side and never shuffle the distinct values themselves).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _distinct(c: str, approx: bool):
    return F.approx_count_distinct(c) if approx else F.count_distinct(F.col(c))


def raw_summary(bronze: DataFrame, approx: bool = False) -> DataFrame:
    """Total events, distinct players, distinct event days, first/last event time."""
    ts = F.try_to_timestamp(F.col("timestamp"))
    return bronze.select("player_id", ts.alias("_ts"), F.to_date(ts).alias("_day")).agg(
        F.count(F.lit(1)).alias("total_events"),
        _distinct("player_id", approx).alias("unique_players"),
        _distinct("_day", approx).alias("days_covered"),
        F.min("_ts").alias("first_event"),
        F.max("_ts").alias("last_event"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Row count and NULL count of every column, one row."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns])


def event_distribution(df: DataFrame, col: str = "event_type") -> DataFrame:
    """Events per type, most frequent first."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("events"))
            .orderBy(F.desc("events"), F.asc(col)))


def distinct_values(df: DataFrame, col: str = "event_type") -> DataFrame:
    """The distinct values of a column."""
    return df.select(col).distinct()


def bronze_quality(bronze: DataFrame, approx: bool = False) -> DataFrame:
    """Events, players and missing payloads per raw event type."""
    return (bronze.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"),
        _distinct("player_id", approx).alias("players"),
        F.count_if(F.col("payload").isNull()).alias("missing_payloads"),
    ).orderBy(F.desc("events"), "event_type"))


def silver_quality_summary(cleaned: DataFrame, approx: bool = False) -> DataFrame:
    """Events, players, missing payloads by event date x normalised type."""
    return (cleaned.groupBy("event_date", "event_type_normalized").agg(
        F.count(F.lit(1)).alias("event_count"),
        _distinct("player_id", approx).alias("unique_players"),
        F.sum(F.when(F.col("payload").isNull(), 1).otherwise(0)).cast("long").alias("missing_payload_count"),
    ))


def duplicate_check(layers: dict[str, DataFrame], key: str = "event_id") -> DataFrame:
    """Rows, distinct keys and duplicates (rows - distinct) per layer.

    One row per layer via ``unionByName`` of per-layer global aggregates.
    """
    out = None
    for name, df in layers.items():
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(F.col(key)).alias("unique_ids"))
        one = one.select(F.lit(name).alias("layer"), "rows", "unique_ids",
                         (F.col("rows") - F.col("unique_ids")).alias("dupes"))
        out = one if out is None else out.unionByName(one)
    return out


def cleaned_profile(cleaned: DataFrame, approx: bool = False) -> DataFrame:
    """Rows, distinct events and players, first/last event time."""
    return cleaned.agg(
        F.count(F.lit(1)).alias("rows"),
        _distinct("event_id", approx).alias("unique_events"),
        _distinct("player_id", approx).alias("unique_players"),
        F.min("event_ts").alias("first_event"),
        F.max("event_ts").alias("last_event"),
    )


def preview(df: DataFrame, n: int = 20, order_by: list[str] | None = None) -> DataFrame:
    """H2: a display preview -- the limit is the feature. Ordered first (ties by
    every column) so the preview is reproducible; planned as TakeOrderedAndProject."""
    keys = order_by or df.columns
    return df.orderBy(*keys).limit(n)
