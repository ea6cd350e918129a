"""Layer jobs on URI roots, mixed modes, vanished dates, stored views, training snapshots, the model registry."""
import pytest
from pyspark.sql import functions as F

from conftest import raw_rows
from respawn import jobs
from respawn.operators import ml
from respawn.plans import layers
from respawn.sources import files


def land(spark, tmp, rows, name="one"):
    files.export_csv(raw_rows(spark, rows), f"{tmp}/landing/{name}")
    return f"{tmp}/landing/*"


def days(spark, path):
    return sorted(str(r[0]) for r in spark.read.parquet(path).select("event_date").distinct().collect())


def test_catalog_on_a_uri_root(spark, tmp):
    root = f"file://{tmp}/lake"
    layers.build_bronze(spark, land(spark, tmp, [{}, {"event_type": "kill"}]), root)
    layers.build_silver(spark, root)
    assert "silver.player_events_cleaned" in layers.register_catalog(spark, root)
    assert spark.table("silver.player_events_cleaned").count() == 2
    props = {r[0]: r[1] for r in spark.sql("SHOW TBLPROPERTIES silver.player_events_cleaned").collect()}
    assert props["quality"] == "silver" and props["pipeline"] == "respawn" and props["source"] == "bronze.raw_events"
    with pytest.raises(FileNotFoundError):
        layers.register_catalog(spark, f"file://{tmp}/nothing")
    with pytest.raises(ValueError, match="reads from it"):
        files.write_table(spark.read.parquet(f"{root}/silver/player_events_cleaned"), f"{tmp}/lake/silver/player_events_cleaned", ["event_date"])


def test_batch_and_stream_keep_apart(spark, tmp):
    landing = land(spark, tmp, [{}, {"event_type": "kill"}])
    for first in (True, False):
        root = f"{tmp}/lake{first}"
        layers.build_bronze(spark, landing, root)
        layers.build_silver(spark, root, stream=first)
        with pytest.raises(ValueError, match="stream"):
            layers.build_silver(spark, root, stream=not first)
        assert spark.read.parquet(f"{root}/silver/player_events_cleaned").count() == 2


def test_a_recompute_drops_vanished_dates(spark, tmp):
    path = f"{tmp}/cleaned"
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02")], "id string, d string").withColumn("event_date", F.to_date("d"))
    files.write_table(df, path, ["event_date"], whole=True)
    files.write_table(df.where("id = 'b'"), path, ["event_date"])
    assert days(spark, path) == ["2024-01-01", "2024-01-02"]  # by partition: others stay
    files.write_table(df.where("id = 'b'"), path, ["event_date"], whole=True)
    assert days(spark, path) == ["2024-01-02"]


def test_malformed_lines_and_batches_are_counted(spark, tmp):
    landing = land(spark, tmp, [{}, {"player_id": None}], "good")
    import os
    os.makedirs(f"{tmp}/landing/bad")
    with open(f"{tmp}/landing/bad/x.csv", "w") as f:
        f.write("event_id,player_id,event_type,timestamp,game_mode,region,platform,payload,ingest_ts,ingest_date\n")
        f.write("e9,p,login\n")
        f.write("e8,p,login,2024-01-30 10:00:00,ranked,EU,PC,{},2024-01-30 10:00:00,2024-01-30,one too many\n")
    out = layers.build_bronze(spark, landing, f"{tmp}/lake", max_files_per_trigger=1)
    q = files.read_quality(spark, f"{tmp}/lake/bronze/raw_events_quality")
    failed = {r.rule: (r.n, r.t) for r in q.groupBy("rule").agg(F.sum("failed").alias("n"), F.sum("total").alias("t")).collect()}
    assert out["batches"] >= 2 and failed["well_formed"] == (2, 4) and failed["valid_player_id"][0] == 1


def test_views_training_and_models_from_the_command_line(spark, tmp):
    rows = []
    for p in range(40):
        for d in range(1, 31):
            if (p + d) % (2 + p % 7) == 0 and not (p % 2 and d > 22):
                rows.append({"player_id": f"p{p}", "event_type": "login", "timestamp": f"2024-01-{d:02d} 10:00:00"})
                rows.append({"player_id": f"p{p}", "event_type": "purchase", "timestamp": f"2024-01-{d:02d} 11:00:00", "payload": '{"item_price_usd": %d}' % (p + 1)})
    root, models = f"{tmp}/lake", f"{tmp}/models"
    rows.append({"player_id": "p0", "event_type": "login", "timestamp": "2024-01-30 10:00:00"})
    jobs.main(["ingest", "--landing", land(spark, tmp, rows), "--root", root])
    jobs.main(["silver", "--root", root])
    jobs.main(["gold", "--root", root, "--as-of", "2024-01-30"])
    jobs.main(["training", "--root", root, "--as-of", "2024-01-23"])
    train = spark.read.parquet(f"{root}/gold/churn_training")
    assert {r.churn_label for r in train.select("churn_label").collect()} == {0, 1}
    first = jobs.main(["train", "--root", root, "--models", models, "--algorithm", "logistic_regression", "--label", "next_week", "--promote"])
    second = jobs.main(["train", "--root", root, "--models", models, "--algorithm", "logistic_regression", "--label", "next_week", "--promote"])
    versions = {r.run_id: (r.version, r.stage) for r in ml.models(spark, models).collect()}
    assert versions == {first["run_id"]: (1, "Archived"), second["run_id"]: (2, "Production")}
    with pytest.raises(LookupError):
        ml.promote(spark, models, "nobody")
    jobs.main(["score", "--root", root, "--models", models])
    jobs.main(["bi", "--root", root])
    assert {"gold.player_churn_scores", "gold.vw_retention_churn", "gold.churn_training"} <= set(jobs.main(["catalog", "--root", root])["tables"])
    other = spark.newSession()
    assert other.table("gold.vw_arpu_summary").count() > 0 and other.table("gold.vw_retention_churn").agg(F.sum("players")).first()[0] == 40
