import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from respawn.constants import RAW_COLUMNS  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from respawn.session import build_session
    ckpt = tempfile.mkdtemp(prefix="respawn-test-ckpt-")
    wh = tempfile.mkdtemp(prefix="respawn-test-wh-")
    s = build_session("local[4]", app="respawn-tests", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "8g",
                             "spark.sql.warehouse.dir": wh, "spark.respawn.adapterPartitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def payload(**kv):
    return json.dumps(kv)


def raw_rows(spark, rows):
    """Raw envelope DataFrame from dicts (missing keys -> sensible defaults)."""
    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])
    defaults = {"event_id": None, "player_id": "player_a", "event_type": "login",
                "timestamp": "2024-01-30 10:00:00", "game_mode": "ranked", "region": "EU",
                "platform": "PC", "payload": "{}", "ingest_ts": None, "ingest_date": None}
    out = []
    for i, r in enumerate(rows):
        d = dict(defaults)
        d["event_id"] = f"e{i:05d}"
        d.update(r)
        if d["ingest_ts"] is None and d["timestamp"] and d["timestamp"][:4].isdigit():
            d["ingest_ts"] = d["timestamp"]
        if d["ingest_date"] is None and d["timestamp"]:
            d["ingest_date"] = d["timestamp"][:10]
        out.append(tuple(d[c] for c in RAW_COLUMNS))
    return spark.createDataFrame(out, schema)
