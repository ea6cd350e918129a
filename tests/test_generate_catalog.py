"""Generator determinism / domains, and catalog writers (schemas, comments, properties)."""
import json

from pyspark.sql import functions as F

from conftest import raw_rows
from respawn.constants import EVENT_TYPES, GAME_MODES, PLATFORMS, REGIONS
from respawn.operators import silver
from respawn.sources import files, generate


def test_generator_is_deterministic_and_in_domain(spark):
    seeds = spark.range(2000)
    a = generate.generate_events(seeds, n_players=50, days_back=30)
    b = generate.generate_events(spark.range(2000).repartition(5), n_players=50, days_back=30)
    assert a.exceptAll(b).count() == 0 and a.count() == 2000
    rows = a.collect()
    assert {r["event_type"] for r in rows} == set(EVENT_TYPES)
    assert {r["region"] for r in rows} <= set(REGIONS) and {r["platform"] for r in rows} <= set(PLATFORMS)
    assert all((r["game_mode"] is None) == (r["event_type"] == "logout") for r in rows)
    assert {r["game_mode"] for r in rows if r["game_mode"]} <= set(GAME_MODES)
    assert len({r["player_id"] for r in rows}) <= 50
    for r in rows:
        p = json.loads(r["payload"])
        if r["event_type"] == "session_end":
            assert 300 <= p["duration_seconds"] <= 7200 and 0 <= p["total_kills"] <= 100
        if r["event_type"] == "purchase":
            assert p["item_price_usd"] in (4.99, 9.99, 19.99, 29.99)
    # generated rows pass every bronze rule and parse cleanly
    cleaned = silver.clean_events(silver.bronze_events(a))
    assert cleaned.count() == 2000
    assert cleaned.where(F.col("event_ts").isNull()).count() == 0
    summary = {(r["dimension"], r["value"]): r["events"] for r in generate.generation_summary(a).collect()}
    assert summary[("total", "rows")] == 2000


def test_catalog_tables_with_comment_and_properties(spark):
    files.create_layer_schemas(spark)
    assert {"bronze", "silver", "gold"} <= {d.name for d in spark.catalog.listDatabases()}
    df = raw_rows(spark, [{}, {"event_type": "kill"}])
    files.save_table(df, "bronze.raw_events_t", comment="Bronze raw events",
                     properties={"quality": "bronze", "pipeline": "bronze_ingestion"})
    assert spark.table("bronze.raw_events_t").count() == 2
    props = {r[0]: r[1] for r in spark.sql("SHOW TBLPROPERTIES bronze.raw_events_t").collect()}
    assert props["quality"] == "bronze" and props["pipeline"] == "bronze_ingestion"
    desc = {r[0]: r[1] for r in spark.sql("DESCRIBE TABLE EXTENDED bronze.raw_events_t").collect()}
    assert desc.get("Comment") == "Bronze raw events"
    # overwrite with a different schema is accepted
    files.save_table(df.select("event_id"), "bronze.raw_events_t")
    assert spark.table("bronze.raw_events_t").columns == ["event_id"]
    files.declare_view(df.where("event_type = 'kill'"), "kills_v")
    assert spark.table("kills_v").count() == 1


def test_generated_events_flow_through_all_layers(spark):
    from respawn.operators import gold
    raw = generate.generate_events(spark.range(1000), n_players=100, days_back=30)
    obs_rows = silver.bronze_events(raw).count()
    assert obs_rows == 1000  # generated rows pass every bronze rule
    cleaned = silver.clean_events(silver.bronze_events(raw))
    sessions = silver.sessions_from_end_events(cleaned)
    purchases = silver.purchase_events(cleaned)
    churn = gold.churn_features(cleaned, sessions, purchases, "2024-01-31")
    players = cleaned.select("player_id").distinct().count()
    assert churn.count() == players
    n_end = cleaned.where("event_type_normalized = 'session_end'").count()
    assert sessions.count() == n_end  # every generated session has a positive duration
    arpu = gold.arpu_features(purchases, cleaned, "2024-01-31")
    assert arpu.count() == purchases.select("player_id").distinct().count()
    seg = gold.player_segments(churn)
    assert {r[0] for r in seg.select("engagement_segment").distinct().collect()} <= \
        {"lapsed", "core", "regular", "casual"}
