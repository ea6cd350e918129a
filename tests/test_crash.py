"""Rows and rule counts of an ingest that is killed at every point of a micro-batch."""
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import raw_rows
from respawn.sources import files

#: A driver that dies without any clean-up at a step of batch 1 (or, for "next", when batch 2 starts: batch 1 is committed).
KILLED = """
import os, sys
sys.path.insert(0, {repo!r})
from respawn.session import build_session
from respawn.sources import files
spark = build_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {tmp!r} + "/ckpt", "spark.driver.memory": "1g"}})
counts, move, batch = files.write_counts, files.move, files.write_batch

def die_with_counts(spark, path, dataset, rules, c):
    if c["batch_id"] == 1 and {point!r} == "before counts":
        os._exit(9)
    counts(spark, path, dataset, rules, c)
    if c["batch_id"] == 1 and {point!r} == "after counts":
        os._exit(9)

def die_with_batch(rows, batch_id, *args):
    if batch_id == 2 and {point!r} == "next":
        os._exit(9)
    out = batch(rows, batch_id, *args)
    if batch_id == 1 and {point!r} == "before commit":
        os._exit(9)
    return out

files.write_counts, files.write_batch = die_with_counts, die_with_batch
files.ingest_events(spark, {tmp!r} + "/landing/*", {tmp!r} + "/bronze", {tmp!r} + "/stream", max_files_per_trigger=1)
"""


@pytest.mark.parametrize("point", ["before counts", "after counts", "before commit", "next"])
def test_a_killed_ingest_loses_and_doubles_nothing(spark, tmp, point):
    for i in range(3):
        rows = [{"event_id": f"e{i}{k}", "player_id": None if k == 0 else "p"} for k in range(4)]
        files.export_csv(raw_rows(spark, rows), f"{tmp}/landing/f{i}", single_file=True)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    died = subprocess.run([sys.executable, "-c", KILLED.format(repo=repo, tmp=tmp, point=point)], capture_output=True, timeout=300)
    assert died.returncode == 9, died.stderr[-2000:]
    seen = [r.event_id for r in spark.read.schema(files.RAW_SCHEMA).parquet(f"{tmp}/bronze").collect()]
    assert len(seen) == len(set(seen)) == (3 if point.endswith("counts") else 6)  # whole batches only

    out = files.ingest_events(spark, f"{tmp}/landing/*", f"{tmp}/bronze", f"{tmp}/stream", max_files_per_trigger=1)
    assert out["batches"] == (1 if point == "next" else 2)  # batch 1 is replayed unless it was committed
    bronze = spark.read.parquet(f"{tmp}/bronze")
    assert sorted(r.event_id for r in bronze.collect()) == sorted(f"e{i}{k}" for i in range(3) for k in (1, 2, 3))
    quality = files.read_quality(spark, f"{tmp}/bronze_quality").groupBy("rule").agg(F.sum("total").alias("t"), F.sum("failed").alias("n"))
    assert {r.rule: (r.t, r.n) for r in quality.collect()} == {
        "valid_event_id": (12, 0), "valid_player_id": (12, 3), "valid_event_type": (12, 0), "well_formed": (12, 0)}


def test_a_table_keeps_to_one_checkpoint(spark, tmp):
    files.export_csv(raw_rows(spark, [{}]), f"{tmp}/landing/f", single_file=True)
    files.ingest_events(spark, f"{tmp}/landing/*", f"{tmp}/bronze", f"{tmp}/one")
    with pytest.raises(ValueError, match="another checkpoint"):
        files.ingest_events(spark, f"{tmp}/landing/*", f"{tmp}/bronze", f"{tmp}/two")
    raw_rows(spark, [{}]).write.parquet(f"{tmp}/plain")
    with pytest.raises(ValueError, match="of its own"):
        files.ingest_events(spark, f"{tmp}/landing/*", f"{tmp}/plain", f"{tmp}/three")
