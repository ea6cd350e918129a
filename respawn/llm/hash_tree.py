"""Shards by a hierarchical weighted hash tree, in DataFrame operations only.

A tree has regions, racks in them and shards in those (any depth). A node weighs what its shards
weigh. A row descends from the root: at each level every child draws -ln(u) / weight with u a
hash in (0, 1) of the row's key and the child's path, and the smallest draw wins, so a child gets rows
by its weight. Draws of one child don't depend on the others: when weights change, rows
move between children whose weight changed and the rest of the level only, and rows whose path holds no
changed weight, before and after, stay where they are. A shard that is added as a region of its own changes
no other weight, so it takes rows and no row moves between the old ones.

Keys decide (the law is ``key``): rows with equal keys lie together and copies of a text under other keys
don't. No shuffle is needed to place rows; numbering them shuffles narrow rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from respawn.llm.common import others, stored

#: Regions, racks a region and shards a rack of the query's tree of 24 shards.
SHAPE = (2, 3, 4)
#: Leading hex digits of an MD5 that deal the rows of a shard out to be numbered.
DIGITS = 3


class Leaf(NamedTuple):
    """A shard: the names on its path (region, rack, shard), its number and its weight."""

    path: tuple[str, ...]
    shard: int
    weight: float = 1.0


def tree(shape: Sequence[int] = SHAPE) -> list[Leaf]:
    """A tree of equal weights, its shards numbered from 0 in order of their paths."""
    paths: list[tuple[str, ...]] = [()]
    for size in shape:
        paths = [(*p, str(i)) for p in paths for i in range(size)]
    return [Leaf(p, i) for i, p in enumerate(paths)]


def grown(leaves: Sequence[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, of the next number, as a region of its own."""
    depth, region = len(leaves[0].path), 0
    taken = {leaf.path[0] for leaf in leaves}
    while str(region) in taken:
        region += 1
    return [*leaves, Leaf((str(region), *["0"] * (depth - 1)), max(leaf.shard for leaf in leaves) + 1, weight)]


def children(leaves: Sequence[Leaf]) -> list[dict[str, dict[str, float]]]:
    """For each level, the children of each node and their weights; nodes without weight are left out.

    Raises ValueError for an empty tree, paths of different depths or that repeat, and negative or no weight at all.
    """
    if not leaves or len({len(leaf.path) for leaf in leaves}) > 1 or not leaves[0].path:
        raise ValueError("a tree needs shards, all at one depth")
    if len({leaf.path for leaf in leaves}) < len(leaves) or any("/" in name for leaf in leaves for name in leaf.path):
        raise ValueError("paths must differ, names must not hold '/'")
    if any(not 0 <= leaf.weight < float("inf") for leaf in leaves) or not any(leaf.weight for leaf in leaves):
        raise ValueError("weights must be finite, none negative and one positive")
    levels: list[dict[str, dict[str, float]]] = [{} for _ in leaves[0].path]
    for leaf in leaves:
        for level, own in enumerate(levels):
            kids = own.setdefault("/".join(leaf.path[:level]), {})
            kid = "/".join(leaf.path[:level + 1])
            if leaf.weight:
                kids[kid] = kids.get(kid, 0.0) + leaf.weight
    return [{node: kids for node, kids in own.items() if kids} for own in levels]


def shard_of(leaves: Sequence[Leaf], key: Column) -> Column:
    """The shard of a key (string; null counts as the empty one)."""
    known = F.coalesce(key.cast("string"), F.lit(""))
    node = F.lit("")
    for own in children(leaves):
        kids = F.create_map(*(F.lit(x) if isinstance(x, str) else x for node_kids in own.items() for x in (
            node_kids[0], F.array(*(F.struct(F.lit(k).alias("name"), F.lit(w).alias("weight")) for k, w in node_kids[1].items())))))
        node = F.array_min(F.transform(F.element_at(kids, node), lambda kid: F.struct(
            (-F.ln(_unit(known, kid["name"])) / kid["weight"]).alias("draw"), kid["name"].alias("name"))))["name"]
    numbers = F.create_map(*(F.lit(x) for leaf in leaves for x in ("/".join(leaf.path), leaf.shard)))
    return F.element_at(numbers, node)


def _unit(key: Column, name: Column) -> Column:
    """A double in (0, 1) from the first 52 bits of an MD5."""
    return (F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), name)), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def place(docs: DataFrame, leaves: Sequence[Leaf], id_col: str = "doc_id", text_col: str = "text", prefix: str = "") -> DataFrame:
    """``docs`` plus size (UTF-8 bytes of the text and 8), text_crc32 (unsigned), law (``key``), shard, grown_shard.

    ``grown_shard`` is the shard in ``grown(leaves)``. ``prefix`` is put before the new names; columns
    that already have those names are replaced. All rows stay; no shuffle.

    Null texts count as empty (size 8, CRC 0). Rows with equal ids, repeated or of different
    texts, and all rows without an id, lie in one shard each: the id decides. Texts may be of any
    length. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    new = {"size": (F.octet_length(text) + F.lit(8)).cast("long"), "text_crc32": F.crc32(text.cast("binary")), "law": F.lit("key"),
           "shard": shard_of(leaves, F.col(id_col)), "grown_shard": shard_of(grown(leaves), F.col(id_col))}
    new = {prefix + name: column for name, column in new.items()}
    return docs.select(*(F.col(f"`{c}`") for c in others(docs, *new)), *(column.alias(name) for name, column in new.items()))


def numbered(rows: DataFrame, shard_col: str, id_col: str, slot: str = "slot") -> DataFrame:
    """``rows`` plus ``slot``: gapless numbers from 0 within each shard.

    For narrow rows (ids, sizes, numbers). Equal rows are counted before the shuffle and expanded after
    it, never more in a row than one input partition holds. Each shard is dealt out by a hash of its
    rows: the numbers of a part are its rows in order (id, then the other columns) plus the rows
    of earlier parts, so neither a shard nor an id that many rows share is sorted in one task.
    """
    names = rows.columns
    text = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names))
    counted = rows.withColumn("__split", F.spark_partition_id()).groupBy(*names, "__split").agg(F.count("*").alias("__n"))
    counted = stored(counted.withColumn("__part", F.substring(F.md5(text), 1, DIGITS)), "counted", wide=True)
    totals = counted.groupBy(shard_col, "__part").agg(F.sum("__n").alias("__n"))
    before = W.partitionBy(shard_col).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(shard_col, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    order = W.partitionBy(shard_col, "__part").orderBy(id_col, *(c for c in names if c not in (shard_col, id_col)), "__split")
    first = F.sum("__n").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")
    placed = counted.withColumn("__first", first).join(totals, [shard_col, "__part"])
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1))
    return placed.select(*names, "__first", "__before", copies.alias("__copy")).select(
        *names, (F.col("__before") + F.col("__first") + F.col("__copy")).alias(slot))


def shard_documents(docs: DataFrame, leaves: Sequence[Leaf] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id_col, size, text_crc32, law, shard, grown_shard, slot.

    The tree is the one of 24 shards unless ``leaves`` is given. The cases of ``place`` hold; equal rows get a slot each.
    """
    rows = place(docs.select(id_col, text_col), tree() if leaves is None else leaves, id_col, text_col)
    return numbered(rows.select(id_col, "size", "text_crc32", "law", "shard", "grown_shard"), "shard", id_col)


def write_shards(docs: DataFrame, path: str, leaves: Sequence[Leaf] | None = None, id_col: str = "doc_id") -> None:
    """Write whole rows as Parquet, a folder ``shard=N`` for each shard; large shards get several files."""
    placed = docs.withColumn("shard", shard_of(tree() if leaves is None else leaves, F.col(id_col)))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)


def _draws(level: int, leaves: Sequence[Leaf], source: str) -> str:
    """SQL of one level's winners: (key, node) of ``source`` -> (key, node)."""
    kids = ", ".join(f"('{node}', '{kid}', {weight}::DOUBLE)" for node, own in children(leaves)[level].items() for kid, weight in own.items())
    unit = f"(('0x' || substr(md5(key || ':' || kid), 1, 13))::BIGINT::DOUBLE + 0.5) / {float(1 << 52)}::DOUBLE"
    return (f"SELECT key, arg_min(kid, -ln({unit}) / weight) AS node FROM {source} JOIN (VALUES {kids}) AS kids(node, kid, weight) USING (node) "
            "GROUP BY key")


def _descent(name: str, leaves: Sequence[Leaf]) -> str:
    steps, source = [], "roots"
    for level in range(len(leaves[0].path)):
        steps.append(f"{name}{level} AS ({_draws(level, leaves, source)})")
        source = f"{name}{level}"
    numbers = ", ".join(f"('{'/'.join(leaf.path)}', {leaf.shard}::INT)" for leaf in leaves)
    return ",\n".join([*steps, f"{name} AS (SELECT key, shard FROM {source} JOIN (VALUES {numbers}) AS numbers(node, shard) USING (node))"])


#: The query in DuckDB. CRCs go byte by byte through a table made from the polynomial 0xEDB88320.
ORACLE_SQL = f"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END), i)) AS tab),
bytes AS (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '') AS key, (strlen(coalesce(text, '')) + 8)::BIGINT AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS bytes FROM documents),
crcs AS (
  SELECT doc_id, key, size, xor(list_reduce(bytes, lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]), 4294967295), 4294967295)::BIGINT AS text_crc32
  FROM bytes, crc_table),
roots AS (SELECT DISTINCT key, '' AS node FROM crcs),
{_descent("now", tree())},
{_descent("later", grown(tree()))},
placed AS (
  SELECT doc_id, size, text_crc32, 'key' AS law, now.shard, later.shard AS grown_shard FROM crcs JOIN now USING (key) JOIN later USING (key))
SELECT *, row_number() OVER (
  PARTITION BY shard ORDER BY substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), size, text_crc32, law, shard, grown_shard)), 1, {DIGITS}),
    doc_id NULLS FIRST, size, text_crc32) - 1 AS slot FROM placed
"""
