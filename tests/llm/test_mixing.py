import math

import duckdb
from pyspark.sql import functions as F

import helpers
from conftest import SF_SMALL
from respawn.llm import mixing as op


def test_query_equals_sql(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = op.mix(docs).toPandas().sort_values(["doc_id", "copy"]).reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.execute(op.ORACLE_SQL).df().sort_values(["doc_id", "copy"]).reset_index(drop=True)[got.columns.tolist()]
    assert len(got) == len(want) and all((got[c] == want[c]).all() for c in got.columns)


def test_cdf_is_poisson(spark):
    for rate in (0.0, 0.3, 5.0, 32.0):
        cdf = spark.range(1).select(op.poisson_cdf(F.lit(rate)).alias("c")).first().c
        p, total = math.exp(-rate), 0.0
        for k, c in enumerate(cdf):
            p = p * rate / k if k else p
            total += p
            assert abs(c - total) < 1e-12
        assert abs(cdf[-1] - 1) < 1e-12


def test_means_and_weights(spark):
    rows = [(i, "x" * 10, None, s, 10) for s, n, lo in (("a", 4000, 0), ("b", 2000, 10000), ("c", 100, 20000)) for i in range(lo, lo + n)]
    weights = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 3.0), ("unused", 5.0)], "source string, weight double")
    got = {r.source: r.n for r in op.mix(helpers.docs(spark, rows), weights, epochs=2.0).groupBy("source").agg(F.count("*").alias("n")).collect()}
    total = 2.0 * len(rows)
    for s, share in (("a", 1 / 6), ("b", 2 / 6), ("c", 3 / 6)):  # c: rate 61, in two parts
        assert abs(got[s] - share * total) < 5 * math.sqrt(share * total)


def test_order_is_global_and_repeatable(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    one = {(r.doc_id, r.copy): r.shuffle_key for r in op.mix(docs).collect()}
    two = {(r.doc_id, r.copy): r.shuffle_key for r in op.mix(docs.repartition(5)).collect()}
    assert one == two and len(set(one.values())) == len(one)
    other = {(r.doc_id, r.copy) for r in op.mix(docs, seed="other").collect()}
    assert other != set(one)


def test_odd_rows(spark):
    odd = helpers.clashing(helpers.odd(spark))
    out = op.mix(odd)
    assert set(odd.columns) <= set(out.columns) and len(out.columns) == len(set(out.columns))
    rows = out.collect()
    assert {(r.doc_id, r.text) for r in rows} <= {r[:2] for r in helpers.ODD}
    empty_source = helpers.docs(spark, [(1, None, None, "z", 0), (2, "", None, "z", 0)])
    masses = op.source_masses(empty_source)
    assert [tuple(r) for r in op.rates(masses, op.root_weights(masses)).collect()] == [("z", 1.0)]  # no characters
    assert {r.doc_id for r in op.mix(empty_source).collect()} <= {1, 2}
    none = spark.createDataFrame([("a", 0.0), ("b", -1.0), ("c", None)], "source string, weight double")
    assert op.mix(helpers.odd(spark), none).count() == 0
    assert op.mix(helpers.empty(spark)).count() == 0


def test_salted_join_gives_the_same(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    key = lambda df: sorted((r.doc_id, r.copy, r.shuffle_key) for r in df.collect())
    whole = key(op.mix(docs))
    monkeypatch.setattr(op, "BROADCAST_SOURCES", 0)
    assert key(op.mix(docs)) == whole
