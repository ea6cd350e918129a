"""The prefix trie of conversations: one node for each distinct sequence of first turns.

1. Turns are numbered, and every prefix gets a digest: the sum over its turns of hashes of place and turn.
   Sums are taken within segments of a conversation and shifted by the segments before, so no
   conversation is walked in one task.
2. Equal conversations are counted, then nodes from one of each: the distinct digests with their members.
3. Nodes are dealt out by subtree. A node with more than ``CAP`` turns at or below it belongs to the trunk; the
   subtrees under the trunk are dealt to shards. A shard is a node table: a minimal perfect hash
   gives each digest a slot, which is checked against the digest it was made for; counts are
   scattered into flat arrays by slot and added up through the array of parents' slots, deepest nodes
   first. What the tops of the subtrees hold is added to the trunk, which is a smaller trie treated alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from respawn.llm.common import stored

#: Turns at or below a node from which it belongs to the trunk; a shard holds about as many nodes at most.
CAP = 100_000
#: Turns of a segment: what one task numbers and sums in order at most, unless turns repeat a number.
SEGMENT = 1 << 10
#: Bits of the member ids whose decimal forms are joined before they are hashed in order.
ID_BITS = 9
#: The most turns that a rebuilt conversation takes from another one, and how many conversations share those.
HEAD, FAMILY = 8, 5
NOTHING = bytes(16)
LANES = ("__s1", "__s2", "__s3", "__s4")


def _running(rows: DataFrame, key: str, segment: Column, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """``rows`` plus the running sums of ``values`` over each key, added up segment by segment."""
    rows = rows.withColumn("__segment", segment)
    inner = W.partitionBy(key, "__segment").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(key).orderBy("__segment").rowsBetween(W.unboundedPreceding, -1)
    totals = rows.groupBy(key, "__segment").agg(*(F.sum(v).alias(f"__t{n}") for n, v in values.items()))
    totals = totals.select(key, "__segment", *(F.coalesce(F.sum(f"__t{n}").over(before), F.lit(0)).alias(f"__b{n}") for n in values))
    summed = rows.select("*", *(F.sum(v).over(inner).alias(f"__i{n}") for n, v in values.items())).join(totals, [key, "__segment"])
    return summed.select(*(c for c in rows.columns if c != "__segment"), *((F.col(f"__i{n}") + F.col(f"__b{n}")).alias(n) for n in values))


def ordered(convs: DataFrame, texts: bool = False) -> DataFrame:
    """(conv_id, i, bytes, digest) of each turn, and role and text if asked: i counts from 0 in order of turn.

    A null turn comes first, ties go by role, then text; null roles and texts are empty. Rows without conv_id
    belong to no conversation and go. Other columns play no part.
    """
    rows = convs.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    segment = F.coalesce(F.shiftright("turn", SEGMENT.bit_length() - 1), F.lit(-(1 << 62)))
    rows = _running(rows, "conv_id", segment, [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")], {"i": F.lit(1).cast("long")})
    digest = F.md5(F.concat_ws(":", F.octet_length("role"), "role", "text"))
    return rows.select("conv_id", (F.col("i") - 1).alias("i"), F.octet_length("text").cast("long").alias("bytes"), digest.alias("digest"),
                       *(["role", "text"] if texts else []))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, len) of each, and their turns with d = 1, 2, ... instead of i.

    Conversation c is the first h turns of conversation c - c % 5, then its own after its first h,
    h = crc32 of the decimal c modulo 9.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(HEAD + 1)).alias("h")
    base = (F.col("conv_id") - F.col("conv_id") % F.lit(FAMILY)).alias("base")
    there = own.select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    convs = own.select("conv_id", "n", h, base).join(there, "base", "left")
    taken = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.select("conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))
    convs = stored(convs, "conversations")
    payload = [c for c in turns.columns if c not in ("conv_id", "i")]
    after = turns.join(convs, "conv_id").where("i >= h").select("conv_id", (F.col("i") - F.col("h") + F.col("taken") + 1).alias("d"), "len", *payload)
    heads = turns.where((F.col("i") < HEAD) & (F.col("conv_id") % F.lit(FAMILY) == 0)).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs, "base").where("i < h").select("conv_id", (F.col("i") + 1).alias("d"), "len", *payload)
    return convs.select("conv_id", "len"), after.unionByName(heads)


def _digest(d: Column, sums: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", d, *sums)))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, d, len, bytes, digest, parent): the digest of the first d turns and of one turn less."""
    hashed = F.md5(F.concat_ws(":", "d", "digest"))
    lanes = [F.conv(F.substring(hashed, 8 * j + 1, 8), 16, 10).cast("long") for j in range(len(LANES))]
    rows = turns.select("conv_id", "d", "len", "bytes", *(lane.alias(f"{name}_") for name, lane in zip(LANES, lanes)))
    rows = stored(rows, "turns", wide=True)
    rows = _running(rows, "conv_id", F.shiftright(F.col("d") - 1, SEGMENT.bit_length() - 1), [F.col("d")], {name: F.col(f"{name}_") for name in LANES})
    return rows.select("conv_id", "d", "len", "bytes", _digest(F.col("d"), [F.col(name) for name in LANES]).alias("digest"),
                       _digest(F.col("d") - 1, [F.col(name) - F.col(f"{name}_") for name in LANES]).alias("parent"))


def ends(members: DataFrame) -> DataFrame:
    """(digest, ends_sha256): SHA-256 of the ids of (digest, conv_id), in order and comma-joined.

    Ids are joined within ranges of 512 first; a task then hashes the ranges in order as they stream by.
    """
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    parts = members.groupBy("digest", F.shiftright("conv_id", ID_BITS).alias("part")).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sha = None, None
        for batch in batches:
            found: list[tuple[bytes, str]] = []
            for digest, joined in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist()):
                if digest == now:
                    sha.update(b",")
                else:
                    if now is not None:
                        found.append((now, sha.hexdigest()))
                    now, sha = digest, hashlib.sha256()
                sha.update(joined.encode())
            yield _pairs(found)
        if now is not None:
            yield _pairs([(now, sha.hexdigest())])

    def _pairs(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.binary()), pa.array([s for _, s in found], pa.string())],
                                          ["digest", "ends_sha256"])

    in_order = parts.repartition("digest").sortWithinPartitions("digest", "part").select("digest", "ids")
    return in_order.mapInArrow(run, "digest binary, ends_sha256 string")


class Slots:
    """A minimal perfect hash of distinct 128-bit digests: each has a slot 0, 1, ... of its own.

    At each level the digests left are hashed to about twice as many places; those alone at their place are settled
    there and their slots are numbered in order of places; the others go on to the next level.
    A lookup is checked against the digest that owns the slot, so an unknown one gives -1.
    """

    SPREAD = 2

    def __init__(self, digests: np.ndarray) -> None:
        self.levels: list[tuple[np.ndarray, int]] = []
        left, settled = digests, 0
        while len(left):
            size = self.SPREAD * len(left) + 1
            place = self._place(left, len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            slot = np.where(alone, np.cumsum(alone) - 1 + settled, -1)
            self.levels.append((slot, size))
            settled += int(alone.sum())
            left = left[~alone[place]]
            if len(self.levels) > 200:
                raise ValueError("digests repeat")
        self.owner = np.zeros((settled, 2), dtype=np.uint64)
        self.owner[self._find(digests)] = digests
        if (self.find(digests) < 0).any():
            raise ValueError("slots are not perfect")

    @staticmethod
    def _place(digests: np.ndarray, level: int, size: int) -> np.ndarray:
        x = digests[:, 0] ^ (digests[:, 1] + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64)))
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return ((x ^ (x >> np.uint64(33))) % np.uint64(size)).astype(np.int64)

    def _find(self, digests: np.ndarray) -> np.ndarray:
        out = np.full(len(digests), -1, dtype=np.int64)
        open_ = np.arange(len(digests))
        for level, (slot, size) in enumerate(self.levels):
            found = slot[self._place(digests[open_], level, size)]
            out[open_] = found
            open_ = open_[found < 0]
        return out

    def find(self, digests: np.ndarray) -> np.ndarray:
        """The slots of digests, -1 for those that have none."""
        out = self._find(digests)
        if len(self.owner):
            out[(out < 0) | (self.owner[np.maximum(out, 0)] != digests).any(axis=1)] = -1
        return out


def _words(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests.tolist()), dtype=np.uint64).reshape(-1, 2)


NODE = ("digest binary, parent binary, conv_id bigint, depth bigint, n_convs bigint, up bigint, n_children bigint, n_leaves bigint, saved bigint, "
        "top boolean")


def add_up(nodes: pd.DataFrame) -> pd.DataFrame:
    """One shard: n_children, n_leaves and saved of each node's subtree, from the nodes' own (and carried) figures.

    ``top`` says that the parent is not in the shard; ``up`` is the parent's conv_id (as given for those).
    """
    digests = _words(nodes["digest"])
    slots = Slots(digests)
    at = slots.find(digests)
    n = len(nodes)

    def by_slot(column: np.ndarray) -> np.ndarray:
        flat = np.empty(n, dtype=np.int64)
        flat[at] = column
        return flat

    parent = by_slot(slots.find(_words(nodes["parent"])))
    depth, conv = by_slot(nodes["depth"].to_numpy()), by_slot(nodes["conv_id"].to_numpy())
    children, leaves, saved = (by_slot(nodes[c].to_numpy()) for c in ("n_children", "n_leaves", "saved"))
    inner = parent >= 0
    children += np.bincount(parent[inner], minlength=n)
    leaves[children == 0] = 1
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[inner[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    up = np.where(inner, conv[np.maximum(parent, 0)], by_slot(nodes["up"].to_numpy()))
    return nodes.assign(up=up[at], n_children=children[at], n_leaves=leaves[at], saved=saved[at], top=~inner[at])


def _totals(nodes: DataFrame, paths: DataFrame, cap: int) -> DataFrame:
    """Add up all subtrees: shards under the trunk, then the trunk. ``paths`` are (conv_id, d, len, digest)."""
    spark = nodes.sparkSession
    done = []
    while True:
        n = paths.count()
        if n > cap:
            heavy = paths.groupBy("digest").agg(F.sum(F.col("len") - F.col("d") + 1).alias("turns")).where(F.col("turns") > cap)
            heavy = stored(heavy.join(nodes.select("digest", "conv_id"), "digest").select("digest", F.col("conv_id").alias("owner")), "trunk")
            # how far each conversation's path lies in the trunk, and who owns the last node there
            cuts = paths.join(heavy, "digest").groupBy("conv_id").agg((F.max("d") + 1).alias("cut"), F.max_by("owner", "d").alias("up"))
            cuts = stored(cuts, "cuts")
            units = paths.join(cuts, "conv_id").where("d = cut").select("conv_id", F.col("digest").alias("unit"), "up")
            light = nodes.join(heavy, "digest", "left_anti").join(units, "conv_id")
        else:
            heavy = None
            light = nodes.withColumn("unit", F.lit(b"")).withColumn("up", F.col("conv_id"))
        shards = 2 * -(-n // cap) if n > cap else 1
        light = light.withColumn("shard", F.pmod(F.xxhash64("unit"), F.lit(shards))).withColumn("top", F.lit(True))
        columns = [part.split()[0] for part in NODE.split(", ")]
        summed = stored(light.select("shard", *columns).groupBy("shard").applyInPandas(lambda pdf: add_up(pdf[columns]), NODE), "nodes")
        done.append(summed)
        if heavy is None:
            break
        carried = summed.where("top").groupBy(F.col("parent").alias("digest")).agg(
            F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        trunk = nodes.join(heavy.select("digest"), "digest").join(carried, "digest", "left")
        more = lambda name, c: (F.col(name) + F.coalesce(c, F.lit(0))).alias(name)
        nodes = stored(trunk.select("digest", "parent", "conv_id", "depth", "n_convs", more("n_children", "c"), more("n_leaves", "l"),
                                    more("saved", "s")), "nodes")
        owners = heavy.select(F.col("owner").alias("conv_id")).distinct()
        paths = stored(paths.join(cuts.join(owners, "conv_id").select("conv_id", "cut"), "conv_id").where("d < cut").select(
            "conv_id", "d", (F.col("cut") - 1).alias("len"), "digest"), "paths")
    out = done[0]
    for more_nodes in done[1:]:
        out = out.unionByName(more_nodes)
    return out


def trie(convs: DataFrame, turns: DataFrame, cap: int = CAP) -> DataFrame:
    """The nodes of the conversations ``convs`` (conv_id, len) with ``turns`` (conv_id, d from 1 to len, len, bytes, digest).

    Per node: conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Conversations without turns are members of the root; no conversations, no nodes. (conv_id, depth) names a node.
    """
    found = stored(prefixes(turns), "prefixes", wide=True)
    root = F.lit(hashlib.md5(b":".join([b"0"] * (1 + len(LANES)))).digest())
    last = found.where("d = len").select("digest", "conv_id", "len")
    last = stored(last.unionByName(convs.where("len = 0").select(root.alias("digest"), "conv_id", F.col("len").cast("long"))), "ends")
    alike = last.groupBy("digest").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("m"), F.max("len").alias("len"))
    alike = stored(alike.select("conv_id", "m", "len"), "classes")
    none = F.lit(NOTHING).alias("parent")
    tops = alike.select("conv_id", "m", F.lit(0).cast("long").alias("d"), "len", F.lit(0).cast("long").alias("bytes"), root.alias("digest"), none)
    rows = found.join(alike.select("conv_id", "m"), "conv_id").select("conv_id", "m", "d", "len", "bytes", "digest", "parent").unionByName(tops)
    rows = stored(rows, "paths", wide=True)

    one = lambda c: F.min(c) == F.max(c)
    checked = F.when(one("d") & one("parent") & one("bytes"), F.min("d")).otherwise(F.raise_error(F.lit("two sequences share a digest")).cast("long"))
    nodes = rows.groupBy("digest").agg(F.min("conv_id").alias("conv_id"), checked.alias("depth"), F.min("parent").alias("parent"),
                                       F.sum("m").alias("n_convs"), F.min("bytes").alias("bytes"))
    nodes = nodes.select("digest", "parent", "conv_id", "depth", "n_convs", F.lit(0).cast("long").alias("n_children"), F.lit(0).cast("long").alias("n_leaves"),
                         ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    summed = _totals(stored(nodes, "nodes"), rows.select("conv_id", "d", "len", "digest"), cap)
    named = summed.join(ends(last), "digest", "left")
    return named.select("conv_id", "depth", F.when(F.col("depth") > 0, F.col("up")).alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(convs: DataFrame, cap: int = CAP) -> DataFrame:
    """The trie of the rebuilt conversations of ``convs`` (conv_id, turn, role, text): see ``ordered``, ``rebuilt`` and ``trie``.

    Repeated rows are turns of their own; empty and very long texts are turns like any other; extra columns don't matter.
    """
    return trie(*rebuilt(stored(ordered(convs), "ordered", wide=True)), cap)


def node_turns(nodes: DataFrame, convs: DataFrame) -> DataFrame:
    """``nodes`` of ``conversation_trie(convs)`` with role and text of each node's last turn (null for the root)."""
    turns = rebuilt(ordered(convs, texts=True))[1].select("conv_id", F.col("d").alias("depth"), "role", "text")
    return nodes.join(turns, ["conv_id", "depth"], "left")


#: The query in DuckDB: prefixes as joined digests, subtrees by joining each node with the prefixes of its first member.
ORACLE_SQL = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), i)) AS tab),
plain AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i FROM plain),
counts AS (SELECT conv_id, count(*) AS n, conv_id - conv_id % {FAMILY} AS base FROM turns GROUP BY conv_id),
hashed AS (
  SELECT conv_id, n, base, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda x: ('0x' || x)::BIGINT),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) % {HEAD + 1} AS h FROM counts, crc_table),
convs AS (
  SELECT a.conv_id, a.base, a.h, least(a.h, coalesce(b.n, 0)) AS taken, least(a.h, coalesce(b.n, 0)) + greatest(a.n - a.h, 0) AS len
  FROM hashed a LEFT JOIN counts b ON a.base = b.conv_id),
rebuilt AS (
  SELECT conv_id, i - h + taken + 1 AS d, role, text FROM turns JOIN convs USING (conv_id) WHERE i >= h
  UNION ALL SELECT convs.conv_id, i + 1, role, text FROM turns JOIN convs ON turns.conv_id = convs.base WHERE i < h),
prefixes AS (
  SELECT conv_id, d, strlen(text) AS bytes, md5(string_agg(md5(strlen(role)::VARCHAR || ':' || role || ':' || text), ',') OVER (
    PARTITION BY conv_id ORDER BY d)) AS node FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
paths AS (SELECT *, lag(node) OVER (PARTITION BY conv_id ORDER BY d) AS parent FROM prefixes),
nodes AS (SELECT node, min(conv_id) AS conv_id, d, count(*) AS n_convs, min(bytes) AS bytes, min(parent) AS parent FROM paths GROUP BY node, d),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
subtrees AS (
  SELECT p.node, sum((x.n_convs - 1) * x.bytes) AS saved_tokens, count(*) FILTER (WHERE kids.node IS NULL) AS n_leaves
  FROM nodes x LEFT JOIN kids ON x.node = kids.node JOIN prefixes p ON p.conv_id = x.conv_id AND p.d <= x.d GROUP BY p.node),
ends AS (
  SELECT node, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM prefixes JOIN convs USING (conv_id) WHERE d = len GROUP BY node)
SELECT x.conv_id::BIGINT AS conv_id, x.d::BIGINT AS depth, up.conv_id::BIGINT AS parent_conv_id, x.n_convs::BIGINT AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
  coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM nodes x LEFT JOIN nodes up ON x.parent = up.node LEFT JOIN kids ON x.node = kids.node JOIN subtrees ON x.node = subtrees.node
LEFT JOIN ends ON x.node = ends.node
"""
