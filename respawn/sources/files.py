"""File sources and table sinks.

* Raw events arrive as CSV files with a header; the schema is fixed and every
  column is a string (A2). JSON payloads contain commas and doubled quotes, so
  the reader and writer both use ``quote='"'`` and ``escape='"'``.
* Incremental ingest (A1/O1/O4) is a Structured Streaming file source with a
  checkpoint: each run (``availableNow``) reads only files not seen before,
  applies the bronze expectations and adds a folder ``batch_id=N`` to the bronze table.
  Rows and rule counts of a micro-batch come from one pass, are written under its id
  and become visible by one rename before the batch is committed: see :func:`write_batch`.
* Table writes overwrite dynamically by partition (history accumulates per
  compute date) and refuse to overwrite a table the job also reads (X18).
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from respawn.constants import RAW_COLUMNS
from respawn.operators import dq
from respawn.session import mark, move, path_exists

# A2: the raw envelope. Declared non-null where the contract says so; file
# streams report every column nullable anyway, so the expectations are the guard.
RAW_SCHEMA = StructType([
    StructField(c, StringType(), c not in ("event_id", "player_id", "event_type", "timestamp"))
    for c in RAW_COLUMNS
])
#: Holds a line that doesn't fit the schema; only its presence is used.
CORRUPT = "_corrupt_record"
WELL_FORMED = dq.Rule("well_formed", f"{CORRUPT} IS NULL", dq.WARN)
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
               # keep padding: raw values are stored exactly as sent
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


# --------------------------------------------------------------------------- batch
def read_raw_csv(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """A3: batch read of raw CSV files (fixed schema, or inferred for exploration)."""
    reader = spark.read.options(**CSV_OPTIONS)
    if infer:
        return reader.option("inferSchema", "true").csv(path)
    return reader.schema(RAW_SCHEMA).csv(path)


def describe(df: DataFrame) -> dict:
    """A3: shape and schema summary (one count job)."""
    return {"rows": df.count(), "columns": len(df.columns),
            "schema": [(f.name, f.dataType.simpleString()) for f in df.schema.fields]}


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV export with header. ``single_file`` (opt-in, for hand-off only) funnels the
    data through one task, so never use it in the main path."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


# --------------------------------------------------------------------------- streaming ingest
def raw_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None, mark_malformed: bool = False) -> DataFrame:
    """A1: streaming CSV source over a landing folder (new files only); ``mark_malformed`` adds the
    column ``CORRUPT``."""
    fields = [*RAW_SCHEMA.fields, *([StructField(CORRUPT, StringType())] if mark_malformed else [])]
    r = spark.readStream.options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", CORRUPT).schema(StructType(fields))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.csv(source_dir)


class LateRowsListener:
    """Counts the rows that *every* micro-batch dropped behind the watermark
    (``recentProgress`` keeps only the last 100 updates)."""

    def __init__(self, spark: SparkSession):
        from pyspark.sql.streaming import StreamingQueryListener

        dropped: dict[tuple[str, int], int] = {}

        class _L(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                p = event.progress
                dropped[(str(p.id), int(p.batchId))] = sum(int(op.numRowsDroppedByWatermark or 0) for op in p.stateOperators or [])

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        self.spark, self.dropped, self.listener = spark, dropped, _L()
        spark.streams.addListener(self.listener)

    def late(self, query) -> dict[int, int]:
        """Rows dropped behind the watermark, by batch."""
        return {b: n for (q, b), n in self.dropped.items() if q == str(query.id)}

    def close(self) -> None:
        self.spark.streams.removeListener(self.listener)


def progress_metrics(query, name: str) -> list[dict]:
    """Observed metrics of every micro-batch of a finished query: [{batch_id, rows, <rule>_failed...}]."""
    out = []
    for p in query.recentProgress:
        get = (lambda k: p.get(k)) if isinstance(p, dict) else (lambda k: getattr(p, k, None))
        observed = get("observedMetrics") or {}
        row = observed.get(name)
        if row is None:
            continue
        d = row.asDict() if hasattr(row, "asDict") else dict(row)
        out.append({"batch_id": int(get("batchId")), **{k: int(v) for k, v in d.items()}})
    return out


#: A file in a table whose rows come from a stream's micro-batches.
STREAMED = "_streamed"


def _counts(spark: SparkSession, metrics_path: str, batch_id: int, rules: list[dq.Rule]) -> dict:
    """The stored counts of a batch as {batch_id, rows, <rule>_failed ...} (a row a rule)."""
    rows = spark.read.parquet(os.path.join(metrics_path, f"batch={batch_id}")).collect()
    failed = {f"{r['rule']}_failed": r["failed"] for r in rows}
    return {"batch_id": batch_id, "rows": rows[0]["total"], **{f"{r.name}_failed": failed.get(f"{r.name}_failed", 0) for r in rules}}


def write_counts(spark: SparkSession, metrics_path: str, dataset: str, rules: list[dq.Rule], counts: dict) -> None:
    """Store one batch's counts, replacing what an earlier attempt stored for it (a few tiny rows)."""
    rows = [{"dataset": dataset, "rule": r.name, "action": r.action, "batch_id": counts["batch_id"],
             "total": counts["rows"], "failed": counts[f"{r.name}_failed"]} for r in rules]
    spark.createDataFrame(rows).coalesce(1).write.mode("overwrite").parquet(os.path.join(metrics_path, f"batch={counts['batch_id']}"))


def write_batch(rows: DataFrame, batch_id: int, path: str, metrics_path: str, dataset: str, rules: list[dq.Rule],
                partition_by: tuple[str, ...] | None) -> dict:
    """Add one micro-batch and its rule counts to a table, once however often the batch is replayed.

    1. The rows that pass are written to a hidden folder; the rules are counted in the same pass.
    2. The counts are stored under the batch id.
    3. The hidden folder becomes ``batch_id=N`` by one rename. Only then the stream commits the batch.

    A crash at any point replays the batch: if the rename happened, rows and counts are both there and
    the batch is skipped; if not, no reader has seen any of it and steps 1 and 2 replace what they left.
    """
    spark = rows.sparkSession
    target = f"{path.rstrip('/')}/batch_id={batch_id}"
    if path_exists(spark, target):
        return _counts(spark, metrics_path, batch_id, rules)
    hidden = f"{path.rstrip('/')}/_staging/batch_id={batch_id}"
    seen = Observation()
    w = dq.expect(rows, rules, observation=seen).drop(CORRUPT).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(hidden)
    counts = {"batch_id": batch_id, **{k: int(v) for k, v in seen.get.items()}}
    write_counts(spark, metrics_path, dataset, rules, counts)
    move(spark, hidden, target)
    return counts


def run_batches(stream: DataFrame, path: str, checkpoint: str, metrics_path: str, dataset: str, rules: list[dq.Rule],
                partition_by: tuple[str, ...] | None = None) -> tuple:
    """Run a stream over everything available into a table of micro-batches; returns (query, every batch's counts).

    Refuses a table that something else writes, or whose batches another checkpoint numbered.
    """
    spark = stream.sparkSession
    marker = f"{path.rstrip('/')}/{STREAMED}"
    if path_exists(spark, path) and not path_exists(spark, marker):
        raise ValueError(f"{path} was not written by this stream; it needs a table of its own")
    if path_exists(spark, marker) and not path_exists(spark, checkpoint):
        raise ValueError(f"{path} holds batches of another checkpoint than {checkpoint}")
    mark(spark, marker)
    done: dict[int, dict] = {}

    def take(rows: DataFrame, batch_id: int) -> None:
        done[batch_id] = write_batch(rows, batch_id, path, metrics_path, dataset, rules, partition_by)

    late = LateRowsListener(spark)
    try:
        q = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        q.late = late.late(q)
    finally:
        late.close()
    return q, [done[k] for k in sorted(done)]


def ingest_events(spark: SparkSession, source_dir: str, target_path: str, checkpoint: str,
                  metrics_path: str | None = None, normalize_before_check: bool = False,
                  partition_by: tuple[str, ...] | None = ("ingest_date",),
                  max_files_per_trigger: int | None = None) -> dict:
    """One triggered run of the incremental bronze ingest.

    Reads only files that arrived since the last run (file-source checkpoint), applies the bronze
    expectations and adds the rows to ``target_path``, partitioned by batch and ingest date, and the rule
    counts to ``metrics_path``; a crash neither loses nor doubles rows or counts (:func:`write_batch`).
    Lines with too many or too few fields count as rule ``well_formed``; they are kept, padded or cut.
    """
    rules = [*(dq.RAW_RULES_NORMALIZED if normalize_before_check else dq.RAW_RULES), WELL_FORMED]
    raw = raw_stream(spark, source_dir, max_files_per_trigger, mark_malformed=True)
    batches = run_batches(raw, target_path, checkpoint, metrics_path or target_path.rstrip("/") + "_quality", "raw_events", rules, partition_by)[1]
    return {"input_rows": sum(b["rows"] for b in batches), "batches": len(batches)}


def read_quality(spark: SparkSession, metrics_path: str) -> DataFrame:
    """Accumulated per-batch rule counts of an ingest (B4 over time)."""
    return spark.read.parquet(metrics_path)


# --------------------------------------------------------------------------- tables
def create_layer_schemas(spark: SparkSession, layers=("bronze", "silver", "gold")) -> None:
    """One schema (database) per medallion layer in the session catalog."""
    for name in layers:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def _plain(path: str) -> str:
    """A path without the schemes and slashes that name the same local folder."""
    return re.sub("^file:/*", "/", path.rstrip("/"))


def _sources_of(df: DataFrame) -> set[str]:
    """Root folders of the file tables the plan reads (no file is listed)."""
    leaves, out = df._jdf.queryExecution().analyzed().collectLeaves(), set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and "HadoopFsRelation" in leaf.relation().getClass().getSimpleName():
            roots = leaf.relation().location().rootPaths()
            out.update(_plain(roots.apply(k).toString()) for k in range(roots.size()))
    return out


def cluster_for_partitions(df: DataFrame, partition_by: list[str], sort_by: list[str] | None = None) -> DataFrame:
    """Bring the rows of an output partition (e.g. one compute date) together, so a task writes few
    files. A rebalance, not a fixed number of writers: adaptive execution splits a large partition
    by its bytes and joins small ones. Rows are sorted inside a task by ``sort_by``."""
    return df.hint("rebalance", *partition_by).sortWithinPartitions(*partition_by, *(sort_by or []))


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                sort_by: list[str] | None = None, whole: bool = False) -> None:
    """Write a layer as parquet; with ``partition_by`` only the partitions
    present in ``df`` are replaced (dynamic overwrite), so daily snapshots
    accumulate; ``whole`` replaces all of them (a full recompute). Refuses to overwrite a
    path the plan itself reads (X18) and a stream's table, whose log would still name its files."""
    target = _plain(path)
    if mode == "overwrite" and any(s.startswith(target + "/") or s == target for s in _sources_of(df)):
        raise ValueError(f"refusing to overwrite {path}: the job reads from it")
    if mode == "overwrite" and any(path_exists(df.sparkSession, f"{path.rstrip('/')}/{m}") for m in (STREAMED, "_spark_metadata")):
        raise ValueError(f"refusing to overwrite {path}: a stream writes it")
    if partition_by:
        df = cluster_for_partitions(df, partition_by, sort_by)
    elif sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode(mode).option("partitionOverwriteMode", "static" if whole else "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_table(df: DataFrame, name: str, comment: str | None = None, properties: dict | None = None,
               partition_by: list[str] | None = None) -> None:
    """Managed table with comment and properties (overwrite, schema replaced)."""
    spark = df.sparkSession
    w = df.write.mode("overwrite").format("parquet").option("overwriteSchema", "true")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS '{comment}'")
    if properties:
        props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({props})")


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> None:
    """A10: a catalog table of one file a bucket, rows dealt out and sorted by ``key``, so that what groups or joins by it needs no shuffle."""
    df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def write_clustered(df: DataFrame, path: str, partition_by: str, cluster_by: str, ids: tuple[str, ...] = (), row_group: int = 16 << 20) -> None:
    """A layer for point reads, replaced as a whole.

    Within each partition value the files hold ranges of ``cluster_by`` (a range shuffle, cut by bytes) in small row groups,
    whose minima and maxima rule most of them out for one value; Parquet Bloom filters do so for the columns ``ids``,
    whose values lie anywhere.
    """
    w = df.repartitionByRange(partition_by, cluster_by).sortWithinPartitions(partition_by, cluster_by).write.mode("overwrite")
    w = w.option("partitionOverwriteMode", "static").option("parquet.block.size", str(row_group))
    for c in (cluster_by, *ids):
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.partitionBy(partition_by).parquet(path)


def declare_view(df: DataFrame, name: str) -> None:
    """A non-materialised, named view."""
    df.createOrReplaceTempView(name)
