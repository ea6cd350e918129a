"""Incremental batch silver equals a full recompute and rewrites only the dates that new rows touch."""
import os

import pytest
from pyspark.sql import functions as F

from conftest import raw_rows
from respawn.operators import silver
from respawn.plans import incremental, layers
from respawn.sources import files

DAY = "2024-01-{:02d} 10:00:00"


def land(spark, tmp, name, rows):
    files.export_csv(raw_rows(spark, rows), f"{tmp}/landing/{name}", single_file=True)
    layers.build_bronze(spark, f"{tmp}/landing/*", f"{tmp}/lake")


def event(i, day, ingest=None, **more):
    return {"event_id": f"e{i}", "timestamp": DAY.format(day) if day else "not a time", "ingest_ts": ingest or DAY.format(day or 1), "ingest_date": "2024-01-20", **more}


def check(spark, tmp):
    """The cleaned table against a recompute from all of bronze."""
    cleaned = spark.read.parquet(f"{tmp}/lake/silver/player_events_cleaned").select(*silver.CLEANED_COLUMNS)
    bronze = spark.read.parquet(f"{tmp}/lake/bronze/raw_events").select(*files.RAW_SCHEMA.fieldNames())
    want = silver.clean_events(bronze).select(*silver.CLEANED_COLUMNS)
    assert cleaned.exceptAll(want).count() == 0 and want.exceptAll(cleaned).count() == 0
    return cleaned


def written(tmp):
    top = f"{tmp}/lake/silver/player_events_cleaned"
    return {d: max(os.stat(f"{top}/{d}/{f}").st_mtime_ns for f in os.listdir(f"{top}/{d}")) for d in os.listdir(top) if "=" in d}


def test_only_touched_dates_are_rewritten(spark, tmp):
    land(spark, tmp, "a", [event(i, 1 + i % 5) for i in range(20)] + [event(90, None)])
    out = layers.build_silver(spark, f"{tmp}/lake", incremental=True)
    assert len(out["dates"]) == 6 and check(spark, tmp).count() == 21
    before = written(tmp)
    # a new event, a later copy of an old one (dropped), an earlier copy of another one on another day (moves), a new date
    land(spark, tmp, "b", [event(50, 2), event(0, 1, DAY.format(19)), event(7, 9, DAY.format(1), payload='{"a": 1}'), event(51, 8)])
    out = layers.build_silver(spark, f"{tmp}/lake", incremental=True)
    assert out["dates"] == ["2024-01-02", "2024-01-03", "2024-01-08", "2024-01-09"]
    after = written(tmp)
    assert {d for d in after if after[d] != before.get(d)} == {f"event_date={d}" for d in out["dates"]}
    check(spark, tmp)
    assert layers.build_silver(spark, f"{tmp}/lake", incremental=True) == {"batches": 0, "dates": []}
    # the only row of a date moves away: the date goes
    land(spark, tmp, "c", [event(51, 1, DAY.format(2))])
    assert layers.build_silver(spark, f"{tmp}/lake", incremental=True)["dates"] == ["2024-01-01", "2024-01-08"]
    check(spark, tmp)
    assert "event_date=2024-01-08" not in written(tmp)


@pytest.mark.parametrize("step", ["state", "half"])
def test_a_crashed_run_is_mended_by_the_next(spark, tmp, monkeypatch, step):
    land(spark, tmp, "a", [event(i, 1 + i % 3) for i in range(9)])
    layers.build_silver(spark, f"{tmp}/lake", incremental=True)
    land(spark, tmp, "b", [event(1, 7, DAY.format(1)), event(60, 2)])  # e1 moves from day 2 to day 7
    write = files.write_table

    def failing(df, path, partition_by=None, **more):
        if path.endswith("player_events_cleaned") and step == "half":  # only one of the dates is replaced
            write(df.where("event_date = DATE'2024-01-07'"), path, partition_by, **more)
            raise RuntimeError("killed")
        write(df, path, partition_by, **more)
        if path.endswith("player_events_cleaned"):
            raise RuntimeError("killed")

    monkeypatch.setattr(files, "write_table", failing)
    with pytest.raises(RuntimeError):
        layers.build_silver(spark, f"{tmp}/lake", incremental=True)
    monkeypatch.undo()
    layers.build_silver(spark, f"{tmp}/lake", incremental=True)
    check(spark, tmp)


def test_old_ids_are_met_by_a_bloom_filter(spark, tmp):
    n = 200_000
    rows = spark.range(n).select(F.concat(F.lit("e"), "id").alias("event_id"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("event_date"))
    rows.write.partitionBy("event_date").parquet(f"{tmp}/cleaned")
    spark.range(50).select(F.concat(F.lit("e"), F.col("id") * 7).alias("event_id"), F.lit(3).alias("batch_id")).write.partitionBy("batch_id").parquet(f"{tmp}/bronze")
    sizes = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1k", "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10m",
             "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        met = incremental.met_by(spark.read.parquet(f"{tmp}/cleaned"), spark.read.parquet(f"{tmp}/bronze").where("batch_id > 2"))
        assert met.count() == 50
        assert "might_contain" in met._jdf.queryExecution().optimizedPlan().toString()
    finally:
        for k in sizes:
            spark.conf.unset(k)


def test_streams_over_two_restarts(spark, tmp):
    """The merged stream equals the batch on all columns; the stateful one drops what comes again 30 days later."""
    from respawn.streaming import silver_stream

    days = [[event(1, 1), event(2, 2)], [event(3, 3), event(1, 1, "2024-01-31 10:00:00")], [event(2, 9, "2024-01-01 09:00:00"), event(4, 4, "2024-02-20 10:00:00")]]
    for k, rows in enumerate(days):
        land(spark, tmp, f"d{k}", rows)
        bronze = silver_stream.bronze_file_stream(spark, f"{tmp}/lake/bronze/raw_events", files.RAW_SCHEMA)
        incremental.merge_stream(spark, bronze, f"{tmp}/lake/silver/player_events_cleaned", f"{tmp}/ckpt", f"{tmp}/staging")
        check(spark, tmp)
        silver_stream.build_silver_stream(spark, f"{tmp}/lake/bronze/raw_events", f"{tmp}/stateful", f"{tmp}/ckpt2")
    ids = sorted(r.event_id for r in spark.read.parquet(f"{tmp}/stateful").collect())
    assert ids == ["e1", "e2", "e3", "e4"]
    assert any("RocksDB" in open(f).read() for f in __import__("glob").glob(f"{tmp}/ckpt2/offsets/*") if not f.endswith(".crc"))
