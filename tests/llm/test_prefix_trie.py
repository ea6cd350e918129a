import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from respawn.llm import prefix_trie as op

CONVS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own.setdefault(c, []).append((role or "", text or ""))
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        rest = abs(c) % 5 * (1 if c >= 0 else -1)
        seqs[c] = tuple(own.get(c - rest, [])[:h] + own[c][h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    kids = {}
    for s in members:
        if s:
            kids.setdefault(s[:-1], []).append(s)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for s in members:
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in kids
            saved[s[:d]] += (len(members[s]) - 1) * len(s[-1][1].encode()) if s else 0
    out = []
    for s, own_members in members.items():
        ends = ",".join(map(str, sorted(c for c in own_members if len(seqs[c]) == len(s))))
        out.append((min(own_members), len(s), min(members[s[:-1]]) if s else None, len(own_members), len(kids.get(s, [])), leaves[s], saved[s],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows, **kw):
    df = op.conversation_trie(spark.createDataFrame(rows, CONVS), **kw)
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_sql(spark):
    convs = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    want = sorted(con.execute(op.ORACLE_SQL).fetchall(), key=str)
    assert sorted((tuple(r) for r in op.conversation_trie(convs).collect()), key=str) == want
    assert sorted((tuple(r) for r in op.conversation_trie(convs, cap=20).collect()), key=str) == want


def bushy():
    rng = random.Random(5)
    rows = []
    for c in range(-12, 90):
        length = rng.randrange(1, 12)
        rows += [(c, t, rng.choice(["user", "assistant"]) if t % 3 else "user", rng.choice(["a", "bb", "é"]) if t > 2 else "hello") for t in range(length)]
    rows += [(200 + 5 * k, t, "user", "same first turn" if not t else f"x{t}") for k in range(30) for t in range(10)]  # copies
    rows += [(1001, t, "user", f"long {t}") for t in range(40)] + [(1002, 1, None, None), (1003, None, None, "n"), (1003, None, "z", "n"), (1003, 4, "", "")]
    rows += [(1004, 1, "user", "tie"), (1004, 1, "user", "tie"), (1004, 1, "assistant", "tie"), (None, 1, "user", "lost")]
    return rows


def test_any_cap_and_segment_equals_brute_force(spark, monkeypatch):
    rows = bushy()
    want = brute(rows)
    assert got(spark, rows) == want
    monkeypatch.setattr(op, "SEGMENT", 4)
    assert got(spark, rows, cap=10) == want  # trunk of a trunk
    monkeypatch.setattr(op, "ID_BITS", 1)
    assert got(spark, rows, cap=60) == want


def test_odd_tables(spark):
    assert got(spark, []) == [] and got(spark, [(None, 1, "u", "t")]) == []
    one = [(3, None, None, None)]
    assert got(spark, one) == brute(one)
    clash = spark.createDataFrame([(5, 0, "user", "x" * 200000), (6, 0, "user", "")], CONVS)
    for name in ("digest", "d", "len", "shard", "unit", "i", "n", "depth"):
        clash = clash.withColumn(name, F.lit("extra"))
    assert sorted((tuple(r) for r in op.conversation_trie(clash).collect()), key=str) == brute([(5, 0, "user", "x" * 200000), (6, 0, "user", "")])


def test_nodes_get_their_turns(spark):
    rows = bushy()
    convs = spark.createDataFrame(rows, CONVS)
    nodes = op.conversation_trie(convs)
    turns = op.node_turns(nodes, convs).collect()
    assert len(turns) == nodes.count() and all((r.text is None) == (r.depth == 0) for r in turns)


def test_slots_are_minimal_perfect_and_checked():
    rng = np.random.default_rng(1)
    for n in (1, 2, 1000, 50000):
        digests = rng.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        table = op.Slots(digests)
        assert sorted(table.find(digests).tolist()) == list(range(n))
        assert (table.find(digests + np.uint64(1)) == -1).all()
    with pytest.raises(ValueError):
        op.Slots(np.zeros((2, 2), dtype=np.uint64))
