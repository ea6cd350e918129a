"""Exact arithmetic at any size, exact quantiles, and prices that can't be counted."""
from fractions import Fraction
import random

import pytest
from pyspark.sql import functions as F

from conftest import payload, raw_rows
from respawn.functions import exact
from respawn.functions.quantiles import auc, exact_quantiles
from respawn.operators import bi, dq, gold, silver


def test_division_and_rounding_on_both_sides_of_the_double_range(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(10 ** rng.randint(1, 18)), rng.randrange(1, 10 ** rng.randint(1, 18))) for _ in range(2000)]
    rows += [(2 ** 53 + i, 2 ** 53 - 1 + i) for i in range(-3, 4)] + [(2 ** 63 - 1, d) for d in (1, 2, 3, 2 ** 62, 2 ** 63 - 1)] + [(5, 0), (None, 4), (1, None)]
    df = spark.createDataFrame(rows, "a long, b long")
    for digits in (2, 4, 6):
        got = df.select("a", "b", exact.ratio_round(F.col("a"), F.col("b"), digits).alias("r"),
                        exact.int_div(F.col("a"), F.when(F.col("b") != 0, F.col("b"))).alias("q")).collect()
        for x in got:
            if x.a is None or not x.b:
                assert x.r is None
                continue
            twice = Fraction(2 * x.a * 10 ** digits + x.b, 2 * x.b)
            assert x.r == float(twice.numerator // twice.denominator) / 10 ** digits and x.q == x.a // x.b


def test_views_hold_a_million_players_in_a_group(spark):
    n = 1_000_000
    base = spark.range(n).select(
        F.concat(F.lit("p"), "id").alias("player_id"), F.to_date(F.lit("2024-01-30")).alias("compute_date"), F.lit("EU").alias("region_primary"),
        F.lit("PC").alias("platform_primary"), F.lit("high").alias("risk_tier"), F.lit(0.8125).alias("churn_probability"),
        F.lit(9).alias("days_since_login"), F.lit(99999.99).alias("total_spend_30d"), F.lit("core").alias("engagement_segment"),
        F.lit("whale").alias("revenue_segment"), F.lit(600.5).alias("avg_session_duration_7d"), F.lit(0.5).alias("win_rate_7d"),
        F.lit("gold").alias("premium_tier"), F.lit(1234.5).alias("avg_spend_7d"), F.lit(2345.25).alias("avg_spend_30d"),
        F.lit(9e6).alias("total_spend_90d"), F.lit(7).alias("purchase_frequency_30d"))
    one = bi.vw_retention_churn(base).first()
    assert (one.players, one.avg_churn_probability, one.avg_spend_30d) == (n, 0.8125, 99999.99)
    two = bi.vw_player_segments(base).first()
    assert (two.players, two.avg_session_duration_7d, two.avg_win_rate_7d) == (n, 600.5, 0.5)
    three = bi.vw_arpu_summary(base).first()
    assert (three.paying_players, three.avg_spend_7d, three.avg_spend_30d) == (n, 1234.5, 2345.25)


def test_area_under_the_curve_equals_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    n = 2_000_000
    score = F.pmod(F.xxhash64("id"), F.lit(300_007)).cast("double") / 300_007
    df = spark.range(n).select(score.alias("s"), (F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(1000)) / 1000.0 < score).cast("double").alias("y"))
    got = spark.range(1).select(auc(df, "s", "y").alias("a")).first().a
    want = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0).evaluate(df)
    assert abs(got - want) < 1e-9
    odd = spark.createDataFrame([(0.5, 1.0), (0.5, 0.0), (0.9, 1.0), (0.1, 0.0), (None, 1.0), (float("nan"), 0.0), (0.3, None)], "s double, y double")
    assert spark.range(1).select(auc(odd, "s", "y").alias("a")).first().a == 3.5 / 4
    assert spark.range(1).select(auc(odd.where("y = 1"), "s", "y").alias("a")).first().a is None


def test_quantiles_read_their_input_twice(spark, tmp):
    n = 10_000_000
    spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("x")).write.parquet(f"{tmp}/x")
    df = spark.read.parquet(f"{tmp}/x")
    q = spark.range(1).select(exact_quantiles(df, "x", [0.25, 0.5, 0.99]).alias("q"))
    assert q.first().q == [2499999.0, 4999999.0, 9899999.0]
    plan = q._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") <= 2


def test_quantiles_are_exact_beyond_a_sketch(spark):
    n = 300_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("x"), (F.col("id") % 3 == 0).alias("third"))
    got = spark.range(1).select(exact_quantiles(df, "x", [0.5, 0.95, 1.0, 0.0]).alias("q")).first().q
    assert got == [149999.0, 284999.0, 299999.0, 0.0]
    heavy = df.select(F.when(F.col("third"), F.lit(5.0)).otherwise(F.col("x")).alias("x")).unionAll(spark.sql("SELECT CAST(NULL AS DOUBLE) UNION ALL SELECT double('NaN')"))
    want = sorted(5.0 if i % 3 == 0 else float(i * 7919 % n) for i in range(n))
    got = spark.range(1).select(exact_quantiles(heavy, "x", [0.1, 0.333, 0.9]).alias("q")).first().q
    assert got == [want[n - int(n - p * n) - 1] for p in (0.1, 0.333, 0.9)]
    assert spark.range(1).select(exact_quantiles(df.where("x < 0"), "x", [0.5]).alias("q")).first().q is None


@pytest.fixture()
def cleaned(spark):
    prices = ["9.99", "1e30", '"NaN"', '"Infinity"', "-1", "1e16"]
    rows = [{"event_type": "login"}] + [{"event_type": "purchase", "payload": '{"item_id": "x", "item_price_usd": %s}' % p} for p in prices]
    rows.append({"event_type": "session_end", "payload": payload(duration_seconds=600, total_kills=3, total_deaths=1), "timestamp": "2024-01-30 11:00:00"})
    return silver.clean_events(silver.bronze_events(raw_rows(spark, rows)))


def test_bad_prices_are_counted_and_left_out(spark, cleaned):
    good = silver.purchase_events(cleaned)
    assert [r.item_price_usd for r in good.collect()] == [9.99]
    metrics = dq.rule_metrics(silver.purchase_candidates(cleaned), dq.PURCHASE_RULES, "purchases").first()
    assert (metrics.total, metrics.failed) == (6, 5)
    for sessions, purchases in ((None, None), (silver.sessions_from_end_events(cleaned), good)):
        churn = gold.churn_features(cleaned, sessions, purchases, "2024-01-30").first()
        assert churn.total_spend_30d == 9.99 and churn.match_count_7d == 1
    arpu = gold.arpu_features(None, cleaned, "2024-01-30").first()
    assert arpu.total_spend_90d == 9.99 and arpu.purchase_frequency_7d == 1
    assert silver.sessions_from_login_logout(cleaned).first().spent_usd == 9.99
    assert silver.revenue_by_region_platform(good).first().revenue_usd == 9.99


def test_gold_rules_count_what_they_drop(spark, cleaned):
    nobody = cleaned.withColumn("player_id", F.lit(None).cast("string"))
    both = cleaned.unionByName(nobody)
    metrics = dq.rule_metrics(gold.churn_candidates(both, None, None, "2024-01-30"), dq.CHURN_RULES, "churn").collect()
    assert {(m.rule, m.total, m.failed) for m in metrics} == {("valid_player_id", 2, 1), ("valid_compute_date", 2, 0)}
    assert gold.churn_features(both, None, None, "2024-01-30").count() == 1
    arpu = dq.rule_metrics(gold.arpu_candidates(None, both, "2024-01-30"), dq.ARPU_RULES, "arpu").first()
    assert (arpu.total, arpu.failed) == (2, 1)
