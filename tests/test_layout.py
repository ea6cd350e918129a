"""Cluster layout, persistent views, stored sketches and folds."""
import datetime as dt

import pytest
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import SF_SMALL, raw_rows
from respawn.operators import bi, gold, metrics, ml
from respawn.plans import layers
from respawn.plans.lakehouse import Lakehouse
from respawn.sources import files


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Silver tables and two days of gold from the benchmark events."""
    root, h = str(tmp_path_factory.mktemp("lake")), Lakehouse(spark, SF_SMALL)
    files.write_table(h.cleaned, f"{root}/silver/player_events_cleaned", ["event_date"])
    files.write_table(h.sessions, f"{root}/silver/player_sessions")
    files.write_table(h.purchases, f"{root}/silver/player_purchase_events")
    return root


def test_bucketed_tables_join_by_player_without_a_shuffle(spark, lake):
    names = layers.bucket_by_player(spark, lake, buckets=4)
    events, sessions, purchases = (spark.table(n) for n in names)
    broadcast = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        h = Lakehouse(spark, SF_SMALL)
        for found, want in ((gold.churn_features_joined(events, sessions, purchases, "2024-01-30"), gold.churn_features(h.cleaned, None, None, "2024-01-30")),
                            (gold.arpu_features_joined(purchases, events, "2024-01-30"), gold.arpu_features(None, h.cleaned, "2024-01-30")),
                            (gold.churn_features(events, None, None, "2024-01-30"), None)):
            assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
            if want is not None:
                assert found.exceptAll(want).count() == 0 and found.count() == want.count()
    finally:
        for k, v in broadcast.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    spark.sql("CREATE SCHEMA IF NOT EXISTS others")
    spark.range(3).write.saveAsTable("others.player_events_cleaned_by_player")
    with pytest.raises(ValueError, match="refusing"):
        layers.bucket_by_player(spark, lake, schema="others")
    assert spark.table("others.player_events_cleaned_by_player").count() == 3


def test_point_reads_skip_row_groups(spark, tmp):
    n = 120_000
    df = spark.range(n).select(F.format_string("p%06d", F.col("id") % 2000).alias("player_id"), F.md5(F.col("id").cast("string")).alias("event_id"),
                               F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 2).cast("int")).alias("event_date"), F.sha2(F.col("id").cast("string"), 512).alias("payload"))
    files.write_clustered(df, f"{tmp}/events", "event_date", "player_id", ("event_id",), row_group=64 << 10)
    import glob
    groups = held = 0
    for path in glob.glob(f"{tmp}/events/*/*.parquet"):
        meta = pq.read_metadata(path)
        for g in range(meta.num_row_groups):
            column = meta.row_group(g).column(0)
            groups, held = groups + 1, held + (column.statistics.min <= "p000777" <= column.statistics.max)
    assert groups >= 10 and held <= 4  # of all row groups, those that can hold the player

    def scanned(condition):
        found = spark.read.parquet(f"{tmp}/events").where(condition)
        rows = found.collect()
        plan = found._jdf.queryExecution().executedPlan()
        leaves = plan.collectLeaves()
        return rows, [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())][0]

    rows, read = scanned("player_id = 'p000777'")
    assert len(rows) == 60 and read < n / 4
    one = df.where("event_id > 'a'").first().event_id
    rows, read = scanned(f"event_id = '{one}'")  # ids lie anywhere: only the Bloom filters can tell
    assert len(rows) == 1 and read < n / 4


def test_views_follow_the_tables(spark, tmp):
    h = Lakehouse(spark, SF_SMALL)
    write = lambda df, name: files.write_table(df, f"{tmp}/gold/{name}", ["compute_date"])
    scores = bi.score_with_standin(h.churn)
    write(scores, "player_churn_scores"), write(h.segments, "player_segments"), write(h.arpu, "arpu_features_daily")
    assert layers.bi_views(spark, tmp) == ["gold.vw_retention_churn", "gold.vw_player_segments", "gold.vw_arpu_summary"]
    for name, want in (("vw_retention_churn", bi.vw_retention_churn(h.scores)), ("vw_player_segments", bi.vw_player_segments(h.segments)),
                       ("vw_arpu_summary", bi.vw_arpu_summary(h.arpu))):
        got = spark.newSession().table(f"gold.{name}").select(*want.columns)
        assert got.exceptAll(want).count() == 0 and got.count() == want.count(), name
    # the next day's gold shows in a new session without another run
    write(h.arpu.withColumn("compute_date", F.lit(dt.date(2024, 2, 1))), "arpu_features_daily")
    assert spark.newSession().sql("SELECT DISTINCT compute_date FROM gold.vw_arpu_summary").count() == 2
    spark.sql("DROP VIEW gold.vw_arpu_summary")
    spark.sql("CREATE VIEW gold.vw_arpu_summary AS SELECT 1 AS mine")
    with pytest.raises(ValueError, match="refusing"):
        layers.bi_views(spark, tmp)
    spark.sql("DROP VIEW gold.vw_arpu_summary")


def test_registration_leaves_tables_of_others(spark, tmp):
    files.write_table(spark.createDataFrame(raw_rows(spark, [{}]).collect()), f"{tmp}/silver/player_purchase_events")
    spark.sql("CREATE SCHEMA IF NOT EXISTS silver")
    spark.sql("DROP TABLE IF EXISTS silver.player_purchase_events")
    spark.range(5).write.saveAsTable("silver.player_purchase_events")
    with pytest.raises(ValueError, match="refusing"):
        layers.register_catalog(spark, tmp)
    assert spark.table("silver.player_purchase_events").count() == 5
    spark.sql("DROP TABLE silver.player_purchase_events")


def test_windows_from_stored_sketches(spark, tmp):
    h = Lakehouse(spark, SF_SMALL)
    metrics.daily_sketches(h.cleaned).write.parquet(f"{tmp}/sketches")
    got = {r.activity_date: r for r in metrics.rolling_from_sketches(spark.read.parquet(f"{tmp}/sketches")).collect()}
    exact = metrics.rolling_active(h.cleaned).collect()
    assert len(got) == sum(r.dau > 0 for r in exact)
    for r in exact:
        for c in ("active_7d", "active_30d"):
            assert r.dau == 0 or abs(got[r.activity_date][c] - r[c]) <= max(1, 4 * 1.04 / 2 ** (metrics.LG_K / 2) * r[c])


def test_a_stray_date_does_not_stretch_the_calendar(spark):
    rows = [("p", dt.date(2024, 1, 1)), ("p", dt.date(2024, 1, 3)), ("q", dt.date(9999, 12, 31)), ("q", dt.date(1, 1, 1)), ("q", None)]
    got = metrics.rolling_active(spark.createDataFrame(rows, "player_id string, event_date date")).collect()
    assert [(str(r.activity_date), r.dau, r.active_7d) for r in got] == [("2024-01-01", 1, 1), ("2024-01-02", 0, 1), ("2024-01-03", 1, 1)]


def test_folds_are_the_same_on_any_partitioning(spark):
    features = Lakehouse(spark, SF_SMALL).churn.withColumn("churn_label", (F.crc32("player_id") % 2).cast("int"))
    grid = [{"algorithm": "logistic_regression"}]
    one, two = ml.sweep(features, grid, k=2)[0], ml.sweep(features.repartition(7), grid, k=2)[0]
    assert 0 <= one["auc_mean"] <= 1 and one["auc_std"] >= 0
    assert abs(one["auc_mean"] - two["auc_mean"]) < 1e-6 and abs(one["auc_std"] - two["auc_std"]) < 1e-6
