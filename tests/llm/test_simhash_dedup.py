import random

import numpy as np
import pytest
import xxhash

import helpers
from conftest import SF_SMALL
from respawn.llm import components as comp
from respawn.llm import simhash_dedup as op


def by_hand(text, k=3):
    words = [w for w in (text or "").encode().lower().replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\r", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").split(b" ") if w]
    own = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in own]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows):
    fps = [(i, by_hand(t)) for i, t in rows]
    known = [(i, f) for i, f in fps if i is not None]
    links = [(a, b) for a, x in known for b, y in known if bin(x ^ y).count("1") <= 3]
    roots = helpers.components({i for i, _ in known}, links)
    return sorted(((i, f"{f:016x}", roots.get(i)) for i, f in fps), key=str)


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted(map(tuple, op.simhash_dedup(docs).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    odd = helpers.clashing(helpers.odd(spark))
    assert sorted(map(tuple, op.simhash_dedup(odd).collect()), key=str) == expected([r[:2] for r in helpers.ODD])
    assert op.simhash_dedup(helpers.empty(spark)).count() == 0
    kept = op.keep_first(odd)
    assert kept.columns == odd.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=str)
    roots = {c for i, _, c in expected([r[:2] for r in helpers.ODD]) if i is not None}
    assert ids == sorted([*roots, None, None], key=str)  # rows without an id stay, a repeated id stays once


def test_small_shards_find_all_links(spark):
    """Many splits by both halves and by all bits: chains, dense groups and equal halves."""
    rng = random.Random(3)
    fps = set()
    for _ in range(150):
        f = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            fps.add(f)
            for _ in range(rng.randint(1, 3)):
                f ^= 1 << rng.randrange(64)
    same_half = rng.getrandbits(32) << 32
    fps |= {same_half | rng.getrandbits(32) for _ in range(300)}
    points = np.array(sorted(fps), dtype=np.uint64).view(np.int64)
    rows = spark.createDataFrame([(int(p),) for p in points], "fp long")
    edges = op.linked_fingerprints(rows, shard=40, sample=64)
    roots = {r.node: r.root for r in comp.components(edges).collect()}
    at = points.tolist()
    links = [(a, b) for i, a in enumerate(at) for b in at[i + 1:] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3]
    want = helpers.components(at, links)
    assert {n: roots.get(n, n) for n in at} == want


@pytest.mark.parametrize("edges", [[], [(5, 5)], [(1, None)], [(2, 1), (1, 2), (3, 2)], [(i, i + 1) for i in range(60)],
                                   [(i, 0) for i in range(50)] + [(100 + i, 49) for i in range(50)]])
def test_components(spark, edges):
    got = {r.node: r.root for r in comp.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and b is not None and a != b]
    assert got == helpers.components({n for e in real for n in e}, real)


def test_dense_shards_are_cut_into_blocks(spark):
    """Fingerprints that no vantage point parts: all within a few bits of each other."""
    rng = np.random.default_rng(3)
    fps = np.unique(np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 8, size=(300, 3), dtype=np.uint64), axis=1))
    classes = spark.createDataFrame([(int(x),) for x in fps], "fp long")
    edges = [(r.a, r.b) for r in op.linked_fingerprints(classes, shard=32).collect()]
    want = [(int(a), int(b)) for i, a in enumerate(fps) for b in fps[:i] if int(a ^ b).bit_count() <= op.RADIUS]
    nodes = [int(x) for x in fps]
    assert helpers.components(nodes, edges) == helpers.components(nodes, want) and set(edges) <= set(want) | {(b, a) for a, b in want}


def test_models_come_once_for_many_rows(spark):
    """A tree is sent with the packed rows of a shard, not beside each of its rows; all rows reach their leaves."""
    from respawn.llm import shards

    sent = spark.sparkContext.accumulator(0)

    def route(model, points):
        sent.add(len(model))
        yield 1, np.flatnonzero(points % 2 == 0)
        yield 2, np.flatnonzero(points % 2 != 0)

    rows = spark.range(4000).selectExpr("'s' AS shard", "id", "id AS point").coalesce(2)
    out = shards.refine(rows, "point", lambda name, points, n: bytes(1000) if "." not in name else None, route, cap=100, sample=50)
    assert sorted((r.shard, r.id, r.point) for r in out.collect()) == sorted((f"s.{1 + i % 2}", i, i) for i in range(4000))
    assert sent.value <= 8 * 1000
