"""Embedding near-dedup: a forest of random-projection trees with spill overlap.

Equal vectors collapse to one weighted class. Each tree splits the classes again and again at the
median of their projections on a random direction; classes within ``SPILL`` times the
usual projected distance of a linked pair around the cut go to both sides. All trees' leaves are
compared inside tasks with exact double-precision cosines; a pair that meets in several leaves
counts in the first of their common leaves only, so tasks return a sum for each class and a
spanning forest of the links, never the pairs. Connected components unite the links.

A leaf of near copies that no direction can split is cut into blocks, and each pair of blocks is
one task: memory stays bounded, and all its pairs are compared.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respawn.llm.common import stored
from respawn.llm.components import components
from respawn.llm.shards import refine

COSINE = 0.9
TREES = 4
SPILL = 0.6
#: Classes in a leaf before it is split, and the bounded sample that places the cuts.
LEAF = 2048
SAMPLE = 8192


def unit(points: np.ndarray) -> np.ndarray:
    points = points.astype(np.float64)
    points = points / np.abs(points).max(axis=1, keepdims=True)
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def _direction(seed: int, dim: int) -> np.ndarray:
    d = np.random.default_rng(seed).standard_normal(dim)
    return d / np.linalg.norm(d)


def fit_tree(points: np.ndarray, n: int, spill: float, leaf: int, seed: int):
    """Nested (direction seed, median, left, right); None where no split is wanted or helps."""
    rng = np.random.default_rng(seed)

    def grow(own: np.ndarray):
        if len(own) * n <= leaf * len(points) or len(own) < 32:
            return None
        best = None
        for s in rng.integers(1 << 62, size=4).tolist():
            at = own @ _direction(s, own.shape[1])
            cut = float(np.median(at))
            left, right = at <= cut + spill, at > cut - spill
            worst = max(left.mean(), right.mean())
            if worst < 0.9 and (best is None or worst < best[0]):
                best = worst, s, cut, left, right
        return best and (best[1], best[2], grow(own[best[3]]), grow(own[best[4]]))

    return grow(points)


def route_tree(model: bytes, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    spill, tree = pickle.loads(model)
    points, leaves = unit(points), 0

    def walk(node, at: np.ndarray):
        nonlocal leaves
        if node is None:
            leaves += 1
            if len(at):
                yield leaves, at
            return
        seed, cut, left, right = node
        on = points[at] @ _direction(seed, points.shape[1])
        yield from walk(left, at[on <= cut + spill])
        yield from walk(right, at[on > cut - spill])

    yield from walk(tree, np.arange(len(points)))


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first of each row of ``a`` (ascending, -1 padded at the end) that is in that row of ``b``."""
    shared = ((a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]).any(axis=2)
    return a[np.arange(len(a)), shared.argmax(axis=1)]


def _compare(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Sums of links (a, null, n) and links of a spanning forest (a, b, null) of a pair of blocks."""
    ids, weight, block = pdf["id"].to_numpy(), pdf["weight"].to_numpy(), pdf["block"].to_numpy()
    code, points = int(pdf["code"].iloc[0]), unit(np.stack(pdf["point"].to_numpy()))
    leaves = np.full((len(ids), int(pdf["leaves"].str.len().max())), -1, dtype=np.int64)
    for i, own in enumerate(pdf["leaves"]):
        leaves[i, :len(own)] = own
    one = np.flatnonzero(block == pdf["one"].iloc[0])
    two = np.flatnonzero(block == pdf["two"].iloc[0])
    inside = pdf["one"].iloc[0] == pdf["two"].iloc[0]
    links, parent, edges = np.zeros(len(ids), dtype=np.int64), list(range(len(ids))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for lo in range(0, len(one), 512):
        rows = one[lo:lo + 512]
        near = points[rows] @ points[two].T >= cosine
        if inside:
            near &= rows[:, None] < two[None, :]
        for r in np.flatnonzero(near.any(axis=1)):
            a, b = rows[r], two[near[r]]
            mine = np.concatenate([_first_common(np.repeat(leaves[a][None], len(b[k:k + 4096]), axis=0), leaves[b[k:k + 4096]]) for k in range(0, len(b), 4096)]) == code
            links[a] += weight[b[mine]].sum()
            links[b[mine]] += weight[a]
            for x in b.tolist():
                ra, rx = root(int(a)), root(x)
                if ra != rx:
                    parent[max(ra, rx)] = min(ra, rx)
                    edges.append((ids[a], ids[x]))
    some = np.flatnonzero(links)
    return pd.concat([
        pd.DataFrame({"a": ids[some], "b": pd.array([None] * len(some), dtype="Int64"), "n": pd.array(links[some], dtype="Int64")}),
        pd.DataFrame({"a": [a for a, _ in edges], "b": pd.array([b for _, b in edges], dtype="Int64"), "n": pd.array([None] * len(edges), dtype="Int64")})])


def embedding_dedup(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, trees: int = TREES,
                    leaf: int = LEAF, sample: int = SAMPLE) -> DataFrame:
    """(id_col, n_links, component_id, kept), one row for each row of ``rows``.

    Vectors that are null, empty, zero, or hold a null or non-finite component link with nothing,
    as do vectors of different lengths with each other and rows with a null id (component_id
    null, kept false). Repeated rows are vectors like any other: each counts as a link of the
    others, and all rows that carry the smallest id are kept. An empty table gives no rows;
    other columns aren't read.
    """
    sound = F.col("point").isNotNull() & F.forall("point", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("point", lambda x: x != 0)
    rows = rows.select(F.col(id_col).alias("vec"), F.col(vector_col).alias("point")).withColumn("sound", F.col("vec").isNotNull() & F.coalesce(sound, F.lit(False)))
    good = rows.where("sound").groupBy("point").agg(F.min("vec").alias("first"), F.count("*").alias("weight"))
    classes = stored(good.withColumn("id", F.monotonically_increasing_id()), "classes")

    def spill(dim: int) -> float:
        return SPILL * (2 * (1 - cosine) / dim) ** 0.5  # a linked pair is at most so far apart, over sqrt(dim) on a direction

    def fit(name: str, points: np.ndarray, n: int) -> bytes | None:
        dim = points.shape[1]
        seed = int.from_bytes(name.encode(), "big") % (1 << 63)
        tree = fit_tree(unit(points), n, spill(dim), leaf, seed)
        return tree and pickle.dumps((spill(dim), tree))

    tree = F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree")
    start = classes.select("id", "point", tree).select(F.concat_ws("-", "tree", F.size("point")).alias("shard"), "id", "point")
    leaves = stored(refine(start, "point", fit, route_tree, leaf, sample), "leaves")

    # a leaf's number: its tree, then a hash of its name
    code = F.shiftleft(F.split("shard", "-")[0].cast("long"), 56).bitwiseOR(F.shiftrightunsigned(F.xxhash64("shard"), 8))
    met = leaves.groupBy("id").agg(F.sort_array(F.collect_set(code)).alias("leaves")).join(classes.select("id", "weight"), "id")
    sizes = leaves.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(2.0 * leaf)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("id", F.lit("block")), F.col("blocks")).cast("int")
    dealt = leaves.join(sizes, "shard").withColumn("block", mine).withColumn("code", code)
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.withColumn("one", F.least("block", "other")).withColumn("two", F.greatest("block", "other"))
    found = dealt.join(met, "id").groupBy("shard", "one", "two").applyInPandas(lambda pdf: _compare(pdf, cosine), "a long, b long, n long")
    found = stored(found, "links")

    links = found.where("n IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "id")
    named = classes.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    named = named.join(least, "root").join(links, "id", "left").select("point", "least", (F.col("weight") - 1 + F.coalesce("n", F.lit(0))).alias("n"))
    known = rows.where("sound").join(named, "point", "left").select("vec", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("least", "vec").alias("least"))
    rest = rows.where("NOT sound").select("vec", F.lit(0).cast("long").alias("n"), F.col("vec").alias("least"))
    return known.unionByName(rest).select(F.col("vec").alias(id_col), F.col("n").alias("n_links"), F.col("least").alias("component_id"),
                                          F.coalesce(F.col("vec") == F.col("least"), F.lit(False)).alias("kept"))
