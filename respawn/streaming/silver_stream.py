"""Streaming twins of the bronze/silver operators and stream scoring.

* ``clean_events_stream`` is C1 on a stream: the same typed/parsed projection,
  with de-duplication by ``event_id`` kept in bounded state by a watermark on
  the *arrival* time (``ingest_ts``). Event times come from a shuffled history
  and can be weeks out of order, so watermarking them would drop valid rows;
  arrival time is nearly ordered. The layer job keeps ids for 35 days, in RocksDB with changelog
  checkpoints (state on local disk, its changes in the checkpoint). Redeliveries later than the watermark delay
  are not recognised as duplicates -- the batch twin and :func:`respawn.plans.incremental.merge_stream` (both exact) remove them.
* Expectations on a stream are the same ``dq.expect`` call; their counts land
  in each micro-batch's ``observedMetrics``.
* The de-duplicator never drops a first delivery, even one arriving behind
  the watermark; a redelivery is dropped while its key is in state (at least
  ``delay`` after the first copy). Stateful operators that do drop late rows
  report them as ``numRowsDroppedByWatermark`` (see :func:`dropped_by_watermark`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.ml import PipelineModel

from respawn.operators import dq, ml, silver
from respawn.sources.files import LateRowsListener, progress_metrics, run_batches


def clean_events_stream(bronze_stream: DataFrame, delay: str = "2 days",
                        observation: str | None = "cleaned_expectations") -> DataFrame:
    """O2/O3: streaming C1 -- dedup within ``delay`` of arrival time, then rules."""
    return dq.expect(parsed_stream(bronze_stream, delay), dq.CLEANED_RULES, observation)


def parsed_stream(bronze_stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """O2: typed, de-duplicated and parsed events before the cleaned-table rules."""
    deduped = silver.typed_events(bronze_stream).withWatermark("ingest_ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    return silver.parse_events(deduped)


def bronze_file_stream(spark: SparkSession, bronze_path: str, schema) -> DataFrame:
    """A4: stream the bronze table's files (new files only)."""
    return spark.readStream.schema(schema).parquet(bronze_path)


def run_available(df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None,
                  output_mode: str = "append"):
    """Process everything available now into a parquet table, then stop."""
    w = (df.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode(output_mode).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    listener = LateRowsListener(df.sparkSession)
    try:
        q = w.start()
        q.awaitTermination()
        q.late = listener.late(q)
    finally:
        listener.close()
    return q


def dropped_by_watermark(query) -> int:
    """Rows dropped as too late by the query's stateful operators, over all micro-batches.

    A listener counts every batch; the last progress reports, which are there at once, fill in
    what it hasn't been told yet.
    """
    late = dict(getattr(query, "late", {}))
    for p in query.recentProgress:
        get = (lambda k, p=p: p.get(k)) if isinstance(p, dict) else (lambda k, p=p: getattr(p, k, None))
        dropped = (op.get("numRowsDroppedByWatermark") if isinstance(op, dict) else op.numRowsDroppedByWatermark
                   for op in get("stateOperators") or [])
        late[int(get("batchId"))] = sum(int(v or 0) for v in dropped)
    return sum(late.values())


def observed(query, name: str = "cleaned_expectations") -> list[dict]:
    """O3: per-batch expectation counts of a finished stream."""
    return progress_metrics(query, name)


#: How long the layer job knows an id, and where: beyond the executors' memory.
DELAY = "35 days"
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def build_silver_stream(spark: SparkSession, bronze_path: str, target_path: str, checkpoint: str,
                        metrics_path: str | None = None, delay: str = DELAY) -> dict:
    """O1-O4 for silver: stream new bronze files through C1 into the cleaned
    table (partitioned by batch and event date); each micro-batch's rule counts
    are stored with it (:func:`respawn.sources.files.write_batch`)."""
    schema = spark.read.parquet(bronze_path).schema
    before = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():  # a running checkpoint keeps the provider that it began with
        spark.conf.set(k, v)
    try:
        parsed = parsed_stream(bronze_file_stream(spark, bronze_path, schema), delay)
        q, batches = run_batches(parsed, target_path, checkpoint, metrics_path or target_path.rstrip("/") + "_quality", "player_events_cleaned",
                                 dq.CLEANED_RULES, ("event_date",))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return {"input_rows": sum(b["rows"] for b in batches), "batches": len(batches),
            "dropped_by_watermark": dropped_by_watermark(q)}


def score_stream(model: PipelineModel, feature_stream: DataFrame) -> DataFrame:
    """Score arriving feature rows; the plan stays streaming (no shuffle)."""
    cols = [c for c in feature_stream.columns if c != ml.LABEL]
    return ml.score(model, feature_stream.select(*cols))
