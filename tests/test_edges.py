"""Hand-written edge fixtures (NULLs, boundaries, malformed input)."""
import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from conftest import payload, raw_rows
from respawn.operators import bi, dq, gold, silver

D = dt.date


def _silver(spark, rows):
    cleaned = silver.clean_events(silver.bronze_events(raw_rows(spark, rows)))
    return cleaned, silver.sessions_from_end_events(cleaned), silver.purchase_events(cleaned)


def test_bad_rows_dropped_and_counted(spark):
    raw = raw_rows(spark, [
        {}, {"event_id": None}, {"player_id": None}, {"event_type": "teleport"},
        {"event_type": "Kill"}, {"event_type": None},
    ])
    obs = Observation("bronze")
    kept = silver.bronze_events(raw, obs).collect()
    assert len(kept) == 1
    m = {r["rule"]: r for r in dq.observed_counts(obs, dq.RAW_RULES, "raw_events")}
    assert m["valid_event_id"]["failed"] == 1
    assert m["valid_player_id"]["failed"] == 1
    # unknown, mixed case (parity: checked before normalising) and NULL type fail
    assert m["valid_event_type"]["failed"] == 3
    # normalising first lets ' Kill' through
    assert silver.bronze_events(raw, normalize_before_check=True).count() == 2


def test_rule_metrics_table(spark):
    raw = raw_rows(spark, [{}, {"player_id": None}, {"event_type": None}])
    rows = {r["rule"]: r for r in dq.rule_metrics(raw, dq.RAW_RULES, "raw").collect()}
    assert rows["valid_player_id"]["failed"] == 1 and rows["valid_player_id"]["passed"] == 2
    assert rows["valid_event_type"]["pass_pct"] == 66.67


def test_expect_or_fail_raises(spark):
    df = raw_rows(spark, [{"player_id": None}])
    with pytest.raises(Exception, match="valid_player_id"):
        dq.expect_or_fail(df, "valid_player_id", "player_id IS NOT NULL").collect()


def test_malformed_values_become_null(spark):
    cleaned, _, _ = _silver(spark, [
        {"timestamp": "not-a-time"},
        {"event_type": "kill", "payload": '{"opponent_id": "x", "wea'},
        {"event_type": "session_end", "payload": payload(total_kills="12x", duration_seconds=600)},
        {"event_type": "kill", "payload": payload(headshot="maybe", experience_granted=70)},
    ])
    r = {x["event_id"]: x for x in cleaned.collect()}
    assert r["e00000"]["event_ts"] is None and r["e00000"]["event_date"] is None
    assert r["e00001"]["opponent_id"] is None and r["e00001"]["weapon"] is None
    assert r["e00002"]["session_kills"] is None and r["e00002"]["session_duration_seconds"] == 600
    assert r["e00003"]["headshot"] is None and r["e00003"]["experience_granted"] == 70


def test_duplicates_keep_earliest_ingest(spark):
    cleaned, _, _ = _silver(spark, [
        {"event_id": "a", "ingest_ts": "2024-01-30 10:00:05"},
        {"event_id": "a", "ingest_ts": "2024-01-30 10:00:05"},
        {"event_id": "b", "ingest_ts": "2024-01-30 11:00:00", "payload": "{\"late\": 1}"},
        {"event_id": "b", "ingest_ts": "2024-01-30 10:00:01", "payload": "{\"early\": 1}"},
    ])
    got = {r["event_id"]: r["payload"] for r in cleaned.collect()}
    assert len(got) == 2 and got["b"] == '{"early": 1}'


def test_platform_canonical_and_warn(spark):
    plats = ["pc", " PC ", "console", "Switch", None]
    cleaned, _, _ = _silver(spark, [{"platform": p} for p in plats])
    got = [r["platform"] for r in cleaned.orderBy("event_id").collect()]
    assert got == ["PC", "PC", "Console", "Switch", None]
    obs = Observation("w")
    dq.expect(cleaned, dq.CLEANED_RULES, obs).count()
    assert obs.get["known_platform_failed"] == 1


def test_session_edges(spark):
    end = lambda **kv: {"event_type": "session_end", "payload": payload(**kv)}
    _, sessions, _ = _silver(spark, [
        end(duration_seconds=0, total_kills=1, total_deaths=1),
        end(total_kills=1),
        end(duration_seconds=-5),
        end(duration_seconds=120, total_kills=3, total_deaths=3),
        end(duration_seconds=60, total_kills=2),
    ])
    rows = sessions.orderBy("duration_min").collect()
    assert [r["duration_min"] for r in rows] == [1.0, 2.0]
    one, two = rows
    assert one["deaths"] == 0 and one["kd_ratio"] == 2.0 and one["matches_won"] == 1
    assert two["kills"] == two["deaths"] == 3 and two["matches_won"] == 1 and two["win_rate"] == 1.0


def test_login_logout_sessions(spark):
    t = lambda h, m=0: f"2024-01-30 {h:02d}:{m:02d}:00"
    rows = [
        {"event_type": "logout", "timestamp": t(8)},                       # logout first: ignored
        {"event_type": "login", "timestamp": t(9)},
        {"event_type": "kill", "timestamp": t(9, 10), "payload": payload(experience_granted=60)},
        {"event_type": "purchase", "timestamp": t(9, 30), "payload": payload(item_price_usd=4.99)},
        {"event_type": "logout", "timestamp": t(9, 30)},                   # same instant as purchase
        {"event_type": "death", "timestamp": t(9, 40)},                    # outside any session
        {"event_type": "login", "timestamp": t(10)},                       # overlapping logins
        {"event_type": "login", "timestamp": t(11)},
        {"event_type": "kill", "timestamp": t(11, 5)},                     # open session
    ]
    cleaned, _, _ = _silver(spark, rows)
    s = silver.sessions_from_login_logout(cleaned).orderBy("login_ts").collect()
    assert len(s) == 3
    first, second, third = s
    assert first["logout_ts"] == dt.datetime(2024, 1, 30, 9, 30) and first["duration_min"] == 30.0
    assert first["kills"] == 1 and first["deaths"] == 0 and first["experience_gain"] == 60
    assert first["items_purchased"] == 1 and first["spent_usd"] == 4.99
    assert second["logout_ts"] is None and second["kills"] == 0
    assert third["logout_ts"] is None and third["kills"] == 1 and third["win_rate"] is None


def test_login_sessions_span_days(spark):
    cleaned, _, _ = _silver(spark, [
        {"event_type": "login", "timestamp": "2024-01-28 23:50:00"},
        {"event_type": "kill", "timestamp": "2024-01-29 00:10:00"},
        {"event_type": "logout", "timestamp": "2024-01-30 01:00:00"},
        {"event_type": "kill", "timestamp": "2024-01-30 02:00:00"},
    ])
    s = silver.sessions_from_login_logout(cleaned).collect()
    assert len(s) == 1 and s[0]["kills"] == 1 and s[0]["duration_min"] == 25 * 60 + 10


def _login(player, day):
    return {"player_id": player, "event_type": "login", "timestamp": f"{day} 12:00:00"}


def test_label_edges(spark):
    as_of = D(2024, 1, 30)
    days = {"p6": 6, "p7": 7, "p8": 8, "p14": 14}
    rows = [_login(p, (as_of - dt.timedelta(days=n)).isoformat()) for p, n in days.items()]
    rows.append({"player_id": "never", "event_type": "kill", "timestamp": "2024-01-20 10:00:00"})
    rows.append({"player_id": "future", "event_type": "login", "timestamp": "2024-02-05 10:00:00"})
    cleaned, sessions, purchases = _silver(spark, rows)
    churn = {r["player_id"]: r for r in gold.churn_features(cleaned, sessions, purchases, as_of).collect()}
    assert "future" not in churn  # only data up to the as-of date counts
    assert [churn[p]["days_since_login"] for p in days] == [6, 7, 8, 14]
    assert [churn[p]["churn_label"] for p in days] == [0, 1, 1, 1]
    assert churn["never"]["days_since_login"] is None and churn["never"]["churn_label"] == 0
    # login exactly 7 days ago is inside the inclusive 7-day window
    assert churn["p7"]["login_count_7d"] == 1 and churn["p8"]["login_count_7d"] == 0
    churned = {r["player_id"]: r["churn_label"] for r in
               gold.churn_features(cleaned, sessions, purchases, as_of, never_login="churned").collect()}
    assert churned["never"] == 1
    excl = gold.churn_features(cleaned, sessions, purchases, as_of, never_login="exclude")
    assert "never" not in {r["player_id"] for r in excl.collect()}
    seg = {r["player_id"]: r["engagement_segment"] for r in gold.player_segments(
        gold.churn_features(cleaned, sessions, purchases, as_of)).collect()}
    assert seg["p14"] == "lapsed" and seg["never"] == "casual"


def test_tier_edges(spark):
    amounts = {"t0": 0.0, "t001": 0.01, "t20": 20.0, "t4999": 49.99, "t50": 50.0,
               "t100": 100.0, "t24999": 249.99, "t250": 250.0}
    rows = [{"player_id": p, "event_type": "purchase", "timestamp": "2024-01-29 10:00:00",
             "payload": payload(item_price_usd=v)} for p, v in amounts.items()]
    rows += [{"player_id": "old90", "event_type": "purchase", "timestamp": "2023-11-01 10:00:00",
              "payload": payload(item_price_usd=300.0)},
             {"player_id": "old91", "event_type": "purchase", "timestamp": "2023-10-31 10:00:00",
              "payload": payload(item_price_usd=300.0)}]
    cleaned, _, purchases = _silver(spark, rows)
    arpu = {r["player_id"]: r for r in gold.arpu_features(purchases, cleaned, "2024-01-30").collect()}
    tiers = {p: arpu[p]["premium_tier"] for p in amounts}
    assert tiers == {"t0": "free", "t001": "bronze", "t20": "bronze", "t4999": "bronze", "t50": "silver",
                     "t100": "gold", "t24999": "gold", "t250": "platinum"}
    assert arpu["t250"]["is_whale"] and not arpu["t24999"]["is_whale"]
    # 2023-11-01 is exactly 90 days before 2024-01-30 (inside), 2023-10-31 is 91 (outside)
    assert arpu["old90"]["total_spend_90d"] == 300.0 and arpu["old91"]["total_spend_90d"] == 0.0
    assert arpu["old91"]["premium_tier"] == "free" and arpu["old91"]["avg_spend_all_time"] == 300.0


def test_prob_edges(spark):
    vals = [0.3999, 0.40, 0.75, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "churn_probability double")
    got = [r[0] for r in df.select(bi.risk_tier()).collect()]
    assert got == ["low", "medium", "high", None, None]


def test_point_in_time_refuses_open_horizon(spark):
    cleaned, sessions, purchases = _silver(spark, [_login("a", "2024-01-05"), _login("b", "2024-01-20")])
    ok = gold.churn_point_in_time(cleaned, sessions, purchases, "2024-01-10", 7).collect()
    assert [(r["player_id"], r["churn_label"]) for r in ok] == [("a", 1)]
    with pytest.raises(Exception, match="label horizon"):
        gold.churn_point_in_time(cleaned, sessions, purchases, "2024-01-18", 7).collect()


def test_history_last_day_equals_snapshot(spark):
    from conftest import SF_SMALL
    from respawn.plans.lakehouse import Lakehouse
    h = Lakehouse(spark, SF_SMALL)
    hist = gold.churn_history(h.cleaned, h.sessions, h.purchases, "2024-01-28", "2024-01-30")
    last = hist.where(F.col("compute_date") == F.lit(D(2024, 1, 30)))
    snap = gold.churn_features(h.cleaned, h.sessions, h.purchases, "2024-01-30")
    assert last.exceptAll(snap).count() == 0 and snap.exceptAll(last).count() == 0
    for day in ("2024-01-28", "2024-01-29"):
        one = hist.where(F.col("compute_date") == F.lit(D.fromisoformat(day)))
        ref = gold.churn_features(h.cleaned, h.sessions, h.purchases, day)
        assert one.exceptAll(ref).count() == 0 and ref.exceptAll(one).count() == 0


def test_history_collapses_old_rows_exactly(spark):
    rows = [
        {"player_id": "a", "event_type": "login", "timestamp": "2023-11-01 10:00:00", "platform": "Mobile"},
        {"player_id": "a", "event_type": "kill", "timestamp": "2023-11-02 10:00:00", "platform": "Mobile"},
        {"player_id": "a", "event_type": "kill", "timestamp": "2024-01-29 10:00:00", "platform": "PC"},
        {"player_id": "b", "event_type": "login", "timestamp": "2023-10-01 10:00:00"},
        {"player_id": "c", "event_type": "purchase", "timestamp": "2024-01-10 10:00:00",
         "payload": payload(item_price_usd=19.99)},
        {"player_id": "c", "event_type": "session_end", "timestamp": "2024-01-25 10:00:00",
         "payload": payload(duration_seconds=600, total_kills=2)},
    ]
    cleaned, sessions, purchases = _silver(spark, rows)
    hist = gold.churn_history(cleaned, sessions, purchases, "2024-01-29", "2024-01-30")
    for day in ("2024-01-29", "2024-01-30"):
        one = hist.where(F.col("compute_date") == F.lit(D.fromisoformat(day)))
        ref = gold.churn_features(cleaned, sessions, purchases, day)
        assert one.exceptAll(ref).count() == 0 and ref.exceptAll(one).count() == 0
    a = hist.where("player_id = 'a' AND compute_date = DATE'2024-01-30'").first()
    assert a["first_seen_date"] == D(2023, 11, 1) and a["platform_primary"] == "Mobile"


def test_login_sessions_independent_of_bucket(spark):
    t = lambda d, h, m=0: f"2024-01-{d:02d} {h:02d}:{m:02d}:00"
    rows = [
        {"event_type": "login", "timestamp": t(28, 23, 50)},
        {"event_type": "kill", "timestamp": t(29, 0, 10), "payload": payload(experience_granted=55)},
        {"event_type": "logout", "timestamp": t(29, 3)},
        {"event_type": "kill", "timestamp": t(29, 4)},                   # after logout: no session
        {"event_type": "login", "timestamp": t(29, 5, 59)},
        {"event_type": "purchase", "timestamp": t(29, 6, 1), "payload": payload(item_price_usd=9.99)},
        {"event_type": "login", "timestamp": t(29, 9)},                  # replaces the open one
        {"event_type": "death", "timestamp": t(30, 1)},
        {"event_type": "logout", "timestamp": t(30, 2)},
        {"event_type": "logout", "timestamp": t(30, 3)},                 # second logout: ignored
    ]
    cleaned, _, _ = _silver(spark, rows)
    ref = silver.sessions_from_login_logout(cleaned, "day")
    for b in ("minute", "hour", "week"):
        other = silver.sessions_from_login_logout(cleaned, b)
        assert ref.exceptAll(other).count() == 0 and other.exceptAll(ref).count() == 0
    s = {r["login_ts"].hour: r for r in ref.collect()}
    assert s[23]["kills"] == 1 and s[23]["experience_gain"] == 55 and s[23]["logout_ts"].hour == 3
    assert s[5]["logout_ts"] is None and s[5]["spent_usd"] == 9.99
    assert s[9]["deaths"] == 1 and s[9]["logout_ts"] == dt.datetime(2024, 1, 30, 2)
