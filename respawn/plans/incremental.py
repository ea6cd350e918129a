"""Incremental batch silver: only the dates that new bronze rows touch are rewritten.

The cleaned table holds, for every event id, the first copy by ``silver.DEDUP_ORDER`` of all bronze rows so far.
A minimum over old and new copies is the minimum of the old minimum and the new copies, so a run
needs the new bronze batches and those cleaned rows whose ids they repeat, not the history:

1. new rows (partition filter on ``batch_id``) are typed and reduced to their first copies;
2. cleaned rows of the same ids are found by a semi-join on the id column alone (at scale Catalyst puts a
   Bloom filter of the new ids in front of that scan) and read whole from their dates only;
3. where a new copy comes first, it goes in and the old one, which may lie on another date, goes out (as does one that
   a crashed run left behind);
4. the dates touched are staged and then replaced by dynamic partition overwrite.

Running it again with the same batches changes nothing, so a crash at any point is mended by the next run. The
batches done are recorded last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from respawn.operators import dq, silver
from respawn.session import delete, path_exists
from respawn.sources import files

TYPED = ["event_id", "player_id", "event_type_normalized", "event_ts", "ingest_ts", "ingest_date", "game_mode", "region", "platform", "payload"]


def processed(spark: SparkSession, state: str) -> int:
    """The last bronze batch that the cleaned table holds, -1 for none."""
    return spark.read.parquet(state).agg(F.max("batch_id")).first()[0] if path_exists(spark, state) else -1


def _on(dates: list) -> Column:
    known = [d for d in dates if d is not None]
    there = F.col("event_date").isin(known) if known else F.lit(False)
    return there | F.col("event_date").isNull() if None in dates else there


def met_by(cleaned: DataFrame, bronze: DataFrame) -> DataFrame:
    """(event_id, event_date) of the cleaned rows whose ids the new bronze rows repeat."""
    return cleaned.select("event_id", "event_date").join(bronze.where("event_id IS NOT NULL").select("event_id"), "event_id", "left_semi")


def update_cleaned(spark: SparkSession, bronze_path: str, cleaned_path: str, state: str, staging: str) -> dict:
    """Bring the cleaned table up to date with bronze; returns the batches read and the dates rewritten (none if nothing is new)."""
    last = processed(spark, state)
    bronze = spark.read.parquet(bronze_path).where(F.col("batch_id") > last)
    upto = bronze.agg(F.max("batch_id")).first()[0]
    if upto is None:
        return {"batches": 0, "dates": []}
    dates = merge(spark, bronze, cleaned_path, staging)
    spark.createDataFrame([(int(upto),)], "batch_id long").coalesce(1).write.mode("append").parquet(state)
    return {"batches": int(upto) - last, "dates": dates}


def merge_stream(spark: SparkSession, bronze_stream: DataFrame, cleaned_path: str, checkpoint: str, staging: str):
    """O2 without a horizon: a stream of bronze rows merged into the cleaned table, micro-batch by micro-batch.

    The table itself is the state: a redelivery is dropped however late, an earlier copy that arrives later replaces the one
    that came first, so the table equals the batch result on all columns. A batch that is replayed changes nothing. Runs over
    everything available, then stops.
    """
    def take(rows: DataFrame, batch_id: int) -> None:
        merge(rows.sparkSession, rows, cleaned_path, staging)

    query = bronze_stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def merge(spark: SparkSession, bronze: DataFrame, cleaned_path: str, staging: str) -> list[str]:
    """Merge new bronze rows into the cleaned table; returns the dates rewritten."""
    fresh = silver.typed_events(bronze.select(*files.RAW_SCHEMA.fieldNames())).withColumn("fresh", F.lit(1))
    if path_exists(spark, cleaned_path):
        cleaned = spark.read.parquet(cleaned_path)
        ids = bronze.select("event_id")
        met = met_by(cleaned, bronze)
        met_dates = [r[0] for r in met.select("event_date").distinct().collect()]  # one row a date
        old = cleaned.where(_on(met_dates)).join(ids, "event_id", "left_semi")
        copies = silver.dedup_events(fresh).unionByName(old.select(*TYPED, F.lit(0).alias("fresh")))
    else:
        cleaned, old, copies = None, None, fresh
    files.write_table(silver.dedup_events(copies), f"{staging}/winners", whole=True)
    winners = spark.read.parquet(f"{staging}/winners")
    changed = winners.where("fresh = 1").select("event_id")
    if old is not None:  # a cleaned row that isn't (or, after a crash, is no longer) the first copy
        content = F.xxhash64(*TYPED)
        first = winners.select("event_id", content.alias("first"))
        stale = old.select("event_id", content.alias("own")).join(first, "event_id").where("own <> first").select("event_id")
        changed = changed.unionByName(stale).distinct()
    typed = winners.drop("fresh").join(changed, "event_id", "left_semi")
    files.write_table(dq.expect(silver.parse_events(typed), dq.CLEANED_RULES), f"{staging}/new", whole=True)
    new = spark.read.parquet(f"{staging}/new")
    touched = new.select("event_date")
    if old is not None:
        touched = touched.unionByName(old.join(changed, "event_id", "left_semi").select("event_date"))
    dates = sorted((r[0] for r in touched.distinct().collect()), key=lambda d: (d is not None, d))  # one row a date
    if dates:
        rows = new
        if cleaned is not None:
            kept = cleaned.where(_on(dates)).join(changed, "event_id", "left_anti")
            rows = new.unionByName(kept.select(*new.columns))
        files.write_table(rows, f"{staging}/dates", whole=True)
        rows = spark.read.parquet(f"{staging}/dates")
        files.write_table(rows, cleaned_path, ["event_date"])
        left = {r[0] for r in rows.select("event_date").distinct().collect()}
        for gone in (d for d in dates if d not in left):  # its only rows moved to another date
            delete(spark, f"{cleaned_path.rstrip('/')}/event_date={'__HIVE_DEFAULT_PARTITION__' if gone is None else gone}")
    return [str(d) for d in dates]
