"""Layer jobs: the medallion run as three scheduled Spark jobs.

Each job reads the previous layer's *tables* (parquet folders under ``root``)
and writes its own, so lineage is cut between layers and an executor loss
re-reads parquet instead of recomputing upstream. Every path must live on the
shared filesystem of the cluster.

    build_bronze  landing CSV --(stream, availableNow)--> bronze/raw_events (by batch and ingest_date)
    build_silver  bronze -> silver/{player_events_cleaned (by event_date), player_sessions,
                  player_purchase_events, silver_quality_summary}
    build_gold    silver -> gold/{churn_features_daily, arpu_features_daily,
                  player_segments} (by compute_date, dynamic overwrite -> history)
    build_scores  gold churn (latest date) + Production model -> gold/player_churn_scores
    build_training  K5 snapshot (label from the week after the features) -> gold/churn_training
    bi_views      gold.vw_retention_churn, vw_player_segments, vw_arpu_summary: SQL views over the gold folders
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from respawn.operators import bi, gold, ml, profile, silver
from respawn.session import path_exists
from respawn.sources import files


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def build_bronze(spark: SparkSession, landing_dir: str, root: str, max_files_per_trigger: int | None = None) -> dict:
    return files.ingest_events(spark, landing_dir, _p(root, "bronze", "raw_events"),
                               _p(root, "_checkpoints", "bronze"),
                               metrics_path=_p(root, "bronze", "raw_events_quality"),
                               max_files_per_trigger=max_files_per_trigger)


def build_silver(spark: SparkSession, root: str, stream: bool = False, incremental: bool = False) -> dict:
    """Cleaned events, then the derived silver tables.

    A batch recompute with exact dedup; ``incremental``: the same result, of which only the dates that new bronze
    batches touch are rewritten; ``stream``: only new bronze files, watermark-bounded dedup.
    """
    cleaned_path = _p(root, "silver", "player_events_cleaned")
    out: dict = {}
    if stream:
        from respawn.streaming.silver_stream import build_silver_stream
        out = build_silver_stream(spark, _p(root, "bronze", "raw_events"), cleaned_path,
                                  _p(root, "_checkpoints", "silver"))
    elif incremental:
        from respawn.plans.incremental import update_cleaned
        out = update_cleaned(spark, _p(root, "bronze", "raw_events"), cleaned_path, _p(root, "_checkpoints", "silver_batches"), _p(root, "_staging"))
    else:
        bronze = spark.read.parquet(_p(root, "bronze", "raw_events")).select(*files.RAW_SCHEMA.fieldNames())
        files.write_table(silver.clean_events(bronze), cleaned_path, ["event_date"], whole=True)
    cleaned = spark.read.parquet(cleaned_path)
    files.write_table(silver.sessions_from_end_events(cleaned), _p(root, "silver", "player_sessions"))
    files.write_table(silver.purchase_events(cleaned), _p(root, "silver", "player_purchase_events"))
    files.write_table(profile.silver_quality_summary(cleaned), _p(root, "silver", "silver_quality_summary"))
    return out


def read_silver(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (spark.read.parquet(_p(root, "silver", "player_events_cleaned")),
            spark.read.parquet(_p(root, "silver", "player_sessions")),
            spark.read.parquet(_p(root, "silver", "player_purchase_events")))


def build_gold(spark: SparkSession, root: str, as_of) -> None:
    events = read_silver(spark, root)[0]  # sessions and purchases are read off the events in the same scan
    churn_path = _p(root, "gold", "churn_features_daily")
    by_player = {"partition_by": ["compute_date"], "sort_by": ["player_id"]}
    files.write_table(gold.churn_features(events, None, None, as_of), churn_path, **by_player)
    files.write_table(gold.arpu_features(None, events, as_of), _p(root, "gold", "arpu_features_daily"), **by_player)
    churn = spark.read.parquet(churn_path).where(f"compute_date = DATE'{gold.as_date(as_of)}'")
    files.write_table(gold.player_segments(churn), _p(root, "gold", "player_segments"), **by_player)


def build_training(spark: SparkSession, root: str, window_end, horizon_days: int = 7) -> None:
    """K5 as a table: one snapshot per feature window, labelled by the days after it."""
    events = read_silver(spark, root)[0]
    files.write_table(gold.churn_point_in_time(events, None, None, window_end, horizon_days),
                      _p(root, "gold", "churn_training"), ["compute_date"], sort_by=["player_id"])


def build_history(spark: SparkSession, root: str, start, end, chunk_days: int = 31) -> None:
    """K6 backfill in chunks of ``chunk_days`` compute dates (one partition per
    date, dynamic overwrite). The loop is over date ranges, not over data."""
    import datetime as dt
    events = read_silver(spark, root)[0]
    lo, hi = gold.as_date(start), gold.as_date(end)
    while lo <= hi:
        top = min(hi, lo + dt.timedelta(days=chunk_days - 1))
        files.write_table(gold.churn_history(events, None, None, lo, top),
                          _p(root, "gold", "churn_features_daily"), ["compute_date"], sort_by=["player_id"])
        lo = top + dt.timedelta(days=1)


def build_scores(spark: SparkSession, root: str, model_root: str) -> None:
    churn = spark.read.parquet(_p(root, "gold", "churn_features_daily"))
    model = ml.load_stage(spark, model_root, "Production")
    files.write_table(ml.score(model, bi.latest_snapshot(churn)), _p(root, "gold", "player_churn_scores"), sort_by=["player_id"])


def bi_views(spark: SparkSession, root: str) -> list[str]:
    """The dashboard views M1-M3 as SQL views of schema ``gold`` over the gold folders, and by their bare names in this session.

    They live as long as the session's catalog keeps them (a metastore: for any session) and hold no rows: each
    read sees the gold tables as they are then. Views of tables that aren't there are left out; a name that is
    taken by something else than this pipeline is refused.
    """
    files.create_layer_schemas(spark)
    names = []
    for view, (table, _, _) in bi.VIEW_SQL.items():
        path, name = _p(root, "gold", table), f"gold.{view}"
        if not path_exists(spark, path):
            continue
        if spark.catalog.tableExists(name):
            if not is_ours(spark, name):
                raise ValueError(f"refusing to replace {name}: it is not a view of this pipeline")
            if spark.catalog.getTable(name).tableType != "VIEW":
                spark.sql(f"DROP TABLE {name}")  # the results that earlier versions stored
        spark.sql(f"CREATE OR REPLACE VIEW {name} COMMENT 'Gold: dashboard view {view}' "
                  f"TBLPROPERTIES ('pipeline' = 'respawn', 'quality' = 'gold', 'source' = 'gold.{table}') AS {bi.view_sql(view, path)}")
        files.declare_view(spark.table(name), view)
        names.append(name)
    return names


def bucket_by_player(spark: SparkSession, root: str, buckets: int = 64, schema: str = "silver") -> list[str]:
    """A10: the silver tables as catalog tables bucketed and sorted by player (``<schema>.<table>_by_player``).

    Joins and aggregates by player read them without a shuffle. ``buckets`` is fixed when they are first
    written; a bucket should hold some 128 MB. A name that something else took is refused.
    """
    files.create_layer_schemas(spark)
    names = []
    for table in ("player_events_cleaned", "player_sessions", "player_purchase_events"):
        name = f"{schema}.{table}_by_player"
        if spark.catalog.tableExists(name) and not is_ours(spark, name):
            raise ValueError(f"refusing to replace {name}: it is not a table of this pipeline")
        files.save_bucketed(spark.read.parquet(_p(root, "silver", table)), name, "player_id", buckets)
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('pipeline' = 'respawn', 'quality' = 'silver')")
        names.append(name)
    return names


# Catalog entries for the layer folders: (schema, table, folder, partition column, comment, properties).
CATALOG = [
    ("bronze", "raw_events", "bronze/raw_events", "ingest_date",
     "Bronze: raw player events as delivered, bronze expectations applied", {"quality": "bronze"}),
    ("bronze", "raw_events_quality", "bronze/raw_events_quality", "batch",
     "Bronze: expectation pass/fail counts per ingest micro-batch", {"quality": "bronze"}),
    ("silver", "player_events_cleaned", "silver/player_events_cleaned", "event_date",
     "Silver: de-duplicated, typed, payload-parsed events", {"quality": "silver"}),
    ("silver", "player_sessions", "silver/player_sessions", None,
     "Silver: one row per completed session (session_end events)", {"quality": "silver"}),
    ("silver", "player_purchase_events", "silver/player_purchase_events", None,
     "Silver: purchases with a valid amount", {"quality": "silver"}),
    ("silver", "silver_quality_summary", "silver/silver_quality_summary", None,
     "Silver: events, players and missing payloads by date and type", {"quality": "silver"}),
    ("gold", "churn_features_daily", "gold/churn_features_daily", "compute_date",
     "Gold: per-player churn features and label per compute date", {"quality": "gold"}),
    ("gold", "arpu_features_daily", "gold/arpu_features_daily", "compute_date",
     "Gold: per-player revenue features per compute date", {"quality": "gold"}),
    ("gold", "player_segments", "gold/player_segments", "compute_date",
     "Gold: engagement and revenue segments", {"quality": "gold"}),
    ("gold", "churn_training", "gold/churn_training", "compute_date",
     "Gold: churn features with the label of the days after them", {"quality": "gold"}),
    ("gold", "player_churn_scores", "gold/player_churn_scores", None,
     "Gold: churn probability and risk tier of the latest snapshot", {"quality": "gold"}),
]
#: What the next layer's tables are made from, as a table property.
SOURCES = {"bronze": "landing files", "silver": "bronze.raw_events", "gold": "silver.player_events_cleaned"}


def is_ours(spark: SparkSession, name: str) -> bool:
    """Whether a table or view carries this pipeline's property."""
    return any(r[0] == "pipeline" and r[1] == "respawn" for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect())


def register_catalog(spark: SparkSession, root: str) -> list[str]:
    """Name every written layer folder in the session catalog, with its
    comment and properties, and pick up its partitions. Returns the table names.
    Refuses to replace a table that isn't this pipeline's (property ``pipeline``)."""
    files.create_layer_schemas(spark)
    names = []
    for schema, table, folder, part, comment, props in CATALOG:
        path = _p(root, folder)
        if not path_exists(spark, path):
            continue
        name = f"{schema}.{table}"
        if spark.catalog.tableExists(name) and not is_ours(spark, name):
            raise ValueError(f"refusing to replace {name}: it is not a table of this pipeline")
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # an external table of ours: its files stay
        schema_ddl = spark.read.parquet(path).schema.toDDL()
        if part and path_exists(spark, f"{path}/{files.STREAMED}"):
            part = f"batch_id, {part}"
        part_clause = f"PARTITIONED BY ({part})" if part else ""
        props = props | {"pipeline": "respawn", "source": SOURCES[schema]}
        tbl_props = ", ".join(f"'{k}' = '{v}'" for k, v in props.items())
        spark.sql(f"CREATE TABLE {name} ({schema_ddl}) USING parquet {part_clause} "
                  f"LOCATION '{path}' COMMENT '{comment}' TBLPROPERTIES ({tbl_props})")
        if part:
            try:  # catalogs that track partitions (Hive metastore) need them registered
                spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
            except Exception as ex:  # noqa: BLE001 - in-memory catalog discovers them on read
                if "NOT_A_PARTITIONED_TABLE" not in str(ex):
                    raise
        names.append(name)
    if not names:
        raise FileNotFoundError(f"no layer tables under {root}")
    return names + bi_views(spark, root)
