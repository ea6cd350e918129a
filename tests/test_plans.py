"""Physical-plan properties the design relies on."""
from conftest import SF_SMALL
from respawn.operators import gold, silver
from respawn.plans.lakehouse import Lakehouse
from respawn.sources.driver import raw_events_from_driver, read_table


def _plan(df) -> str:
    """The final adaptive plan (after execution), without the initial-plan section."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def _shuffle_keys(plan: str) -> list[list[str]]:
    out = []
    for chunk in plan.split("hashpartitioning(")[1:]:
        args = chunk.split(")")[0].split(", ")
        out.append([a.split("#")[0] for a in args[:-1]])
    return out


def test_filter_and_projection_reach_the_silver_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # untruncated scan metadata
    h = Lakehouse(spark, SF_SMALL)
    df = h.cleaned.where("event_type_normalized = 'purchase'").select("player_id", "item_price_usd")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "EqualTo(event_type_normalized,purchase)" in pushed and "IsNotNull(player_id)" in pushed
    # only the projected columns plus those the cleaned-table rules need are read
    assert ("ReadSchema: struct<event_id:string,player_id:string,event_type_normalized:string,"
            "item_price_usd:double>") in plan


def test_churn_features_is_one_shuffle_without_joins(spark):
    h = Lakehouse(spark, SF_SMALL)
    plan = _plan(gold.churn_features(h.cleaned, h.sessions, h.purchases, h.as_of))
    assert "Join" not in plan
    assert plan.count("Exchange hashpartitioning(player_id") == 1
    # a hot player is reduced map-side (partial aggregates, incl. the mode maps) before the shuffle
    below = plan.split("Exchange hashpartitioning(player_id", 1)[1]
    assert "partial_count" in below and "partial_mode" in below


def test_history_moves_daily_rows_once_by_player(spark):
    h = Lakehouse(spark, SF_SMALL)
    plan = _plan(gold.churn_history(h.cleaned, h.sessions, h.purchases, "2024-01-25", "2024-01-30"))
    keys = _shuffle_keys(plan)
    # events are reduced map-side to the daily grain first; no join and nothing else is shuffled
    assert sorted(map(len, keys)) == [1, 4] and ["player_id"] in keys, keys
    assert "Join" not in plan


def test_login_sessions_shuffle_events_once(spark):
    from respawn.operators import silver
    h = Lakehouse(spark, SF_SMALL)
    plan = _plan(silver.sessions_from_login_logout(h.cleaned))
    keys = _shuffle_keys(plan)
    # event rows are shuffled once, by (player, hour bucket); later shuffles
    # work on checkpointed per-session partials, not on events
    assert keys.count(["player_id", "b"]) == 1, keys


def test_latest_snapshot_prunes_partitions(spark, tmp):
    from respawn.operators import bi
    from respawn.sources import files
    h = Lakehouse(spark, SF_SMALL)
    files.write_table(gold.churn_history(h.cleaned, h.sessions, h.purchases, "2024-01-28", "2024-01-30"),
                      f"{tmp}/churn", ["compute_date"])
    latest = bi.latest_snapshot(spark.read.parquet(f"{tmp}/churn"))
    assert latest.select("compute_date").distinct().count() == 1
    plan = latest._jdf.queryExecution().executedPlan().toString()
    part = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "compute_date" in part and "subquery" in part.lower()


def test_preview_is_ordered_top_k(spark):
    from respawn.operators import profile
    h = Lakehouse(spark, SF_SMALL)
    df = profile.preview(h.cleaned.select("event_id", "player_id"), 5, ["event_id"])
    plan = _plan(df)
    assert "TakeOrderedAndProject" in plan and df.count() == 5


def test_dedup_collapses_copies_before_the_shuffle(spark):
    from conftest import raw_rows
    from respawn.operators import silver
    # one hot event id delivered 300 times among normal rows
    rows = [{"event_id": "hot", "ingest_ts": f"2024-01-30 10:{i % 60:02d}:00"} for i in range(300)]
    rows += [{"event_id": f"e{i}"} for i in range(50)]
    typed = silver.typed_events(silver.bronze_events(raw_rows(spark, rows).repartition(4)))
    deduped = silver.dedup_events(typed)
    got = {r["event_id"]: r["ingest_ts"] for r in deduped.collect()}
    assert len(got) == 51 and got["hot"].strftime("%H:%M") == "10:00"
    plan = _plan(deduped)
    above, below = plan.split("Exchange hashpartitioning(event_id", 1)
    assert "min(struct(" in above            # final aggregate after the shuffle
    assert "partial_min(struct(" in below    # map-side aggregate before it
    assert below.split("partial_min(")[1].split("]")[0].count("payload#") == 1  # the payload is buffered once


def test_gold_reads_the_events_once(spark):
    h = Lakehouse(spark, SF_SMALL)
    for df in (h.churn, h.arpu):
        assert _plan(df).count("Scan parquet") == 1
    same = gold.churn_features(h.cleaned, h.sessions, h.purchases, h.as_of)
    assert h.churn.exceptAll(same).count() == 0 and same.exceptAll(h.churn).count() == 0


def test_date_window_prunes_partitions_and_rules_reach_the_scan(spark):
    from respawn.plans.catalog import queries
    plan = queries()["date_window_filter"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "In(event_type_normalized" in plan.split("PushedFilters: [")[1].split("ReadSchema")[0]


def test_adapter_and_typing_are_compiled(spark):
    """The JVM never compiles a method of more than 8,000 bytes; the adapter's projection had 14,589."""
    raw = raw_events_from_driver(read_table(spark, SF_SMALL, "events"))
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    for df in (raw, silver.typed_events(silver.bronze_events(raw))):
        found = debug.codegenStringSeq(df._jdf.queryExecution().executedPlan())
        sizes = [found.apply(i)._3().maxMethodCodeSize() for i in range(found.size())]
        assert sizes and max(sizes) <= 8000
