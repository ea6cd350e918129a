import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import helpers
from conftest import SF_SMALL
from respawn.llm import hash_tree as op


def test_query_equals_sql(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = op.shard_documents(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_SMALL}/documents.parquet')")
    want = con.execute(op.ORACLE_SQL).df().sort_values("doc_id").reset_index(drop=True)[got.columns.tolist()]
    assert len(got) == len(want) and all((got[c] == want[c]).all() for c in got.columns)


def shards(spark, leaves, n=20000):
    return [r.s for r in spark.range(n).select(op.shard_of(leaves, F.col("id")).alias("s"), "id").orderBy("id").collect()]


def test_one_more_shard_takes_rows_only_into_itself(spark):
    now = op.tree()
    old, new = shards(spark, now), shards(spark, op.grown(now))
    assert set(old) == set(range(24))
    moved = [(a, b) for a, b in zip(old, new) if a != b]
    assert moved and {b for _, b in moved} == {24}
    assert abs(len(moved) - 20000 / 25) < 150


def test_shards_get_rows_by_weight(spark):
    leaves = [leaf._replace(weight=float(1 + leaf.shard % 3)) for leaf in op.tree()]
    found = shards(spark, leaves)
    for leaf in leaves:
        want = 20000 * leaf.weight / sum(x.weight for x in leaves)
        assert abs(found.count(leaf.shard) - want) < 6 * want ** 0.5


def test_moves_stay_in_changed_subtrees(spark):
    """Shard 0 (region 0, rack 0) gets heavier: rows that don't pass through region 0 anew stay."""
    now = op.tree()
    heavier = [leaf._replace(weight=3.0) if leaf.shard == 0 else leaf for leaf in now]
    path = {leaf.shard: leaf.path for leaf in now}
    for a, b in zip(shards(spark, now), shards(spark, heavier)):
        if a != b:
            assert path[b][0] == "0"  # never into region 1
            if path[a][0] == "0":
                assert path[b][1] == "0"  # within region 0 only into the heavier rack
                if path[a][1] == "0":
                    assert b == 0
    drained = [leaf._replace(weight=0.0) if leaf.shard == 5 else leaf for leaf in now]
    assert 5 not in set(shards(spark, drained))


def test_slots_are_gapless_with_repeated_rows_and_hot_ids(spark):
    rows = helpers.ODD + [(77, "same", "en", "a", 4)] * 500 + [(78, f"text {i}", "en", "a", 6) for i in range(500)] + [(None, f"n {i}", "en", "a", 4) for i in range(300)]
    docs = helpers.docs(spark, rows).repartition(5)
    got = op.shard_documents(docs).collect()
    assert sorted(str((r.doc_id, r.size, r.text_crc32)) for r in got) == sorted(
        str((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode()))) for r in rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    assert all(len({r.shard for r in got if r.doc_id == i}) == 1 for i in (None, 7, 77, 78))
    assert {r.law for r in got} == {"key"} and all(r.grown_shard in (r.shard, 24) for r in got)


def test_clashing_names_and_empty_table(spark):
    docs = helpers.odd(spark)
    clash = helpers.clashing(docs).withColumn("Slot", F.lit("x")).withColumn("size", F.lit("x")).withColumn("Shard", F.lit("x"))
    assert sorted(map(str, op.shard_documents(clash).collect())) == sorted(map(str, op.shard_documents(docs).collect()))
    placed = op.place(clash, op.tree())
    assert placed.count() == docs.count() and dict(placed.dtypes)["size"] == "bigint"
    assert op.shard_documents(helpers.empty(spark)).collect() == []


def test_trees_are_checked():
    for bad in ([], [op.Leaf((), 0)], [op.Leaf(("a",), 0), op.Leaf(("a", "b"), 1)], [op.Leaf(("a",), 0), op.Leaf(("a",), 1)],
                [op.Leaf(("a",), 0, 0.0)], [op.Leaf(("a",), 0, -1.0)], [op.Leaf(("a/b",), 0)]):
        with pytest.raises(ValueError):
            op.children(bad)


def test_written_shards_hold_whole_rows(spark, tmp):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    op.write_shards(docs, f"{tmp}/shards")
    back = spark.read.parquet(f"{tmp}/shards")
    assert back.count() == docs.count()
    assert back.where(F.col("shard") != op.shard_of(op.tree(), F.col("doc_id"))).count() == 0


def test_only_built_in_functions_are_planned(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = op.shard_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert "Exchange" not in op.place(docs, op.tree())._jdf.queryExecution().executedPlan().toString()
