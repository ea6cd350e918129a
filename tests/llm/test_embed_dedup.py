import numpy as np

import helpers
from conftest import SF_SMALL
from respawn.llm import embed_dedup as op

VECTORS = "vec_id long, embedding array<float>, label int"


def expected(rows, cosine=op.COSINE):
    good = [(i, np.array(v, dtype=np.float64)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)]
    links = [[j for j, (_, w) in enumerate(good) if j != k and len(w) == len(v) and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= cosine]
             for k, (_, v) in enumerate(good)]
    edges = [(k, j) for k, own in enumerate(links) for j in own]
    at = helpers.components(range(len(good)), edges)
    least = {}
    for k, r in at.items():
        least[r] = min(least.get(r, good[k][0]), good[k][0])
    out = [(good[k][0], len(links[k]), least[at[k]], good[k][0] == least[at[k]]) for k in range(len(good))]
    rest = [(i, 0, i, i is not None) for i, v in rows
            if not (i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v))]
    return sorted(out + rest, key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    return sorted(map(tuple, op.embedding_dedup(df, **how).collect()), key=str)


def test_whole_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    got = sorted(map(tuple, op.embedding_dedup(df).collect()), key=str)
    assert got == expected([(r.vec_id, r.embedding) for r in df.collect()])


def test_small_leaves_and_dense_groups(spark):
    """Forced splits: no false link, few missed; a dense group larger than a leaf is whole."""
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 32))
    near = [b + rng.normal(size=32) * s for b in base[:60] for s in (0.05, 0.2)]
    dense = rng.normal(size=32) + rng.normal(size=(150, 32)) * 0.02
    vectors = [list(map(float, v.astype(np.float32))) for v in [*base, *near, *dense, *dense[:20]]]
    rows = list(enumerate(vectors))
    got, want = run(spark, rows, leaf=40, sample=256), expected(rows)
    by, truth = {r[0]: r for r in got}, {r[0]: r for r in want}
    assert all(by[i][1] <= truth[i][1] for i in by)
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want)
    assert all(by[i][1] == truth[i][1] for i in range(len(base) + len(near), len(rows)))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [2.0, 0.0]),
            (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [1e30, 1e30]), (11, [1e-30, 1e-30]), (12, [-1.0, 0.0]), (13, [3e38, -3e38])]
    assert run(spark, rows) == expected(rows)
    assert run(spark, []) == []
    df = helpers.clashing(spark.createDataFrame([(1, [1.0, 0.0], 0)], VECTORS)).withColumnRenamed("body", "point")
    assert [tuple(r) for r in op.embedding_dedup(df).collect()] == [(1, 0, 1, True)]
