"""SimHash near-dedup: exact links within a Hamming radius through vantage-point trees.

1. Fingerprint every text (word shingles, XXH64, majority vote per bit).
2. Collapse equal fingerprints to one class each, so copies never meet as pairs.
3. Cut the 64 bits into two halves: two fingerprints within distance 3 differ in at most 1 bit
   of one half. For each half a vantage-point tree partitions the classes by Hamming distance
   to the vantage point. A fingerprint inside the ball but within the radius of its surface
   also visits the outer shard (triangle bound), so each close pair meets in some shard.
   A shard that its half can't split any more is split by all 64 bits at the full radius.
4. Each shard links its members by breadth-first search and returns a spanning forest only.
5. Connected components over the classes, then back to the rows by fingerprint.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from respawn.llm.common import bit_counts, pack_bits, stored
from respawn.llm.components import components
from respawn.llm.shards import refine

SHINGLE = 3
RADIUS = 3
#: Fixed by the contract: the seed of XXH64.
SEED = 42
#: Fingerprints a shard may hold before it is split, and the bounded sample a tree is fitted on.
SHARD = 4096
SAMPLE = 16384


def shingles(text: bytes, k: int) -> list[bytes]:
    words = text.lower().split()  # bytes: only A-Z, and exactly the six ASCII white spaces
    if len(words) < k:
        return [b" ".join(words)] if words else []
    return list(map(b" ".join, zip(*(words[i:] for i in range(k)))))


def simhash64(texts: list[bytes | None], k: int = SHINGLE) -> np.ndarray:
    """One uint64 for each text; 0 for a null text or one without words."""
    out = np.zeros(len(texts), dtype=np.uint64)
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    at, hashes, held = [], [], 0

    def flush() -> None:
        nonlocal held
        if at:
            sizes = np.array([len(h) for h in hashes])
            votes = bit_counts(np.concatenate(hashes), np.concatenate([[0], np.cumsum(sizes)]))
            out[at] = pack_bits(2 * votes > sizes[:, None])
        at.clear(), hashes.clear()
        held = 0

    for i, text in enumerate(texts):
        if text and (own := shingles(text, k)):
            at.append(i)
            hashes.append(np.fromiter(map(digest, own), dtype=np.uint64, count=len(own)))
            if (held := held + len(own)) > 1 << 18:
                flush()
    flush()
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): the 64-bit fingerprint as a signed long, one row for each row of ``docs``."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(simhash64(texts.tolist(), shingle).view(np.int64))

    return docs.select(F.col(id_col).cast("long").alias("id"), run(F.col(text_col).cast("binary")).alias("fp"))


def _distance(points: np.ndarray, vantage: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ vantage) & mask)


def _split(points: np.ndarray, mask: np.uint64, r: int, rng) -> tuple | None:
    """The cheapest (vantage, mu) of a few vantage points: inside is d <= mu, outside d > mu - r."""
    best, n = None, len(points)
    for v in points[rng.choice(n, min(8, n), replace=False)]:
        upto = np.cumsum(np.bincount(_distance(points, v, mask), minlength=65))  # members with d <= i
        for mu in range(r, 64):
            inside, outside = int(upto[mu]), n - int(upto[mu - r])
            cost = inside * inside + outside * outside
            if 0 < inside < 0.95 * n and 0 < outside < 0.95 * n and (best is None or cost < best[0]):
                best = cost, v, mu
    return best


def fit_tree(points: np.ndarray, n: int, parts: list[tuple[int, int]], cap: int, seed: int = 0) -> tuple | None:
    """A vantage-point tree over the first (mask, radius) of ``parts`` that can split the points."""
    rng = np.random.default_rng(seed)

    def grow(own: np.ndarray, mask: np.uint64, r: int):
        if len(own) * n <= cap * len(points) or len(own) < 16 or (found := _split(own, mask, r, rng)) is None:
            return None
        _, v, mu = found
        d = _distance(own, v, mask)
        return int(v), int(mu), grow(own[d <= mu], mask, r), grow(own[d > mu - r], mask, r)

    for mask, r in parts:
        if (tree := grow(points, np.uint64(mask), r)) is not None:
            return mask, r, tree
    return None


def route_tree(model: bytes, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    mask, r, tree = pickle.loads(model)
    points, leaves = points.view(np.uint64), 0

    def walk(node, at: np.ndarray):
        nonlocal leaves
        if node is None:
            leaves += 1
            if len(at):
                yield leaves, at
            return
        v, mu, inside, outside = node
        d = _distance(points[at], np.uint64(v), np.uint64(mask))
        yield from walk(inside, at[d <= mu])
        yield from walk(outside, at[d > mu - r])

    yield from walk(tree, np.arange(len(points)))


def link(points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges (indexes) of a spanning forest of the graph "distance <= radius"."""
    edges, rest = [], np.arange(len(points))
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            a = queue.pop()
            near = np.bitwise_count(points[rest] ^ points[a]) <= radius
            if near.any():
                found = rest[near].tolist()
                edges += [(a, b) for b in found]
                queue += found
                rest = rest[~near]
    return edges


def linked_fingerprints(classes: DataFrame, radius: int = RADIUS, shard: int = SHARD, sample: int = SAMPLE) -> DataFrame:
    """Distinct signed fingerprints (fp) -> edges (a, b) that connect whatever ``radius`` links."""
    halves = [(0xFFFFFFFF00000000, radius // 2), (0x00000000FFFFFFFF, radius // 2)]
    whole = (0xFFFFFFFFFFFFFFFF, radius)

    def fit(name: str, points: np.ndarray, n: int) -> bytes | None:
        half = halves[int(name.split(".")[0])]
        tree = fit_tree(points.view(np.uint64), n, [half, whole], shard)
        return tree and pickle.dumps(tree)

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(pdf["fp"].to_numpy())
        found = link(fps.view(np.uint64), radius)
        return pd.DataFrame({"a": fps[[a for a, _ in found]], "b": fps[[b for _, b in found]]}, dtype="int64")

    rows = classes.select(F.explode(F.array(F.lit("0"), F.lit("1"))).alias("shard"), F.col("fp").alias("id"), "fp")
    leaves = stored(refine(rows, "fp", fit, route_tree, shard, sample), "leaves")
    # a shard that no vantage point splits is cut into blocks, each pair of blocks a task of its own
    sizes = leaves.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(2.0 * shard)).cast("int").alias("blocks"))
    dealt = leaves.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    dealt = dealt.select("shard", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = dealt.select("shard", "fp", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    return pairs.groupBy("shard", "one", "two").applyInPandas(compare, "a long, b long")


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id_col, fingerprint, component_id) for each row of ``docs``.

    fingerprint: 16 lower-case hex digits. component_id: the smallest id reachable over links
    of at most ``radius`` differing bits, the row's own included. Null and empty texts and
    texts of white space have fingerprint zero and link like any other. Rows with a null id get
    a fingerprint and a null component_id and link nothing. Repeated rows each give a row.
    An empty table gives no rows; other columns aren't read.
    """
    fps = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints", wide=True)
    classes = stored(fps.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("first")), "classes")
    roots = stored(components(linked_fingerprints(classes.select("fp"), radius)), "roots")
    merged = classes.join(roots.withColumnRenamed("node", "fp"), "fp")
    least = merged.groupBy("root").agg(F.min("first").alias("component_id"))
    named = classes.join(merged.join(least, "root").select("fp", "component_id"), "fp", "left")
    named = named.select("fp", F.coalesce("component_id", "first").alias("component_id"))
    return fps.join(named, "fp", "left").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, all columns as they were.

    Rows that repeat such an id are one document: the first by text stays. Rows with a null id
    can't be told apart from others and stay.
    """
    groups = simhash_dedup(docs, id_col, text_col, shingle, radius)
    first = groups.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    again = W.partitionBy(id_col).orderBy(text_col)
    found = docs.join(first, id_col, "left_semi").withColumn("__again", F.row_number().over(again))
    return found.where("__again = 1").drop("__again").unionByName(docs.where(F.col(id_col).isNull()))
