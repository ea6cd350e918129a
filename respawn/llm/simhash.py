"""Document fingerprints: weighted SimHash and permuted block tables.

A text's terms are its lower-cased words and its pairs of neighbouring words. Each distinct
term votes +w or -w on every bit of the fingerprint by the bits of its 64-bit hash, where w is
``WORD`` or ``PAIR`` times 1 + ln(occurrences in the text), rounded to a whole number so that votes
add up exactly in any order. A bit is 1 if its votes are positive.

``within`` finds all fingerprints inside a Hamming radius: the 64 bits are cut into
radius + ``MATCH`` blocks; whatever lies within the radius agrees on at least ``MATCH`` whole
blocks, so one table for each choice of ``MATCH`` blocks, keyed by those blocks, holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respawn.llm.common import bit_counts, pack_bits, stored, tasks

RADIUS = 3
MATCH = 2
WORD, PAIR = 16, 64
#: Distinct words whose hash a Python worker remembers.
MEMORY = 1 << 16


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        return found


_HASHES = _Hashes()


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of an ordered pair of hashes (the finalizer of MurmurHash3)."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def weighted_terms(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and weights of the distinct terms of a text."""
    words = text.lower().split()
    own = np.fromiter(map(_HASHES.__getitem__, words), dtype=np.uint64, count=len(words))
    hashes, weights = [], []
    for terms, weight in ((own, WORD), (_mix(own[:-1], own[1:]), PAIR)):
        found, times = np.unique(terms, return_counts=True)
        hashes.append(found)
        weights.append(np.rint(weight * (1 + np.log(times))).astype(np.int64))
    return np.concatenate(hashes), np.concatenate(weights)


def simhash(texts: list[str]) -> np.ndarray:
    """One uint64 for each text; 0 for a text without words. Equal texts have equal ones."""
    out, at, terms = np.zeros(len(texts), dtype=np.uint64), [], []
    held = 0

    def flush() -> None:
        nonlocal held
        if at:
            starts = np.concatenate([[0], np.cumsum([len(h) for h, _ in terms])])
            weights = np.concatenate([w for _, w in terms])
            votes = bit_counts(np.concatenate([h for h, _ in terms]), starts, weights)
            total = np.add.reduceat(weights, starts[:-1])
            out[at] = pack_bits(2 * votes > total[:, None])
        at.clear(), terms.clear()
        held = 0

    for i, text in enumerate(texts):
        own = weighted_terms(text)
        if len(own[0]):
            at.append(i)
            terms.append(own)
            if (held := held + len(own[0])) > 1 << 17:
                flush()
    flush()
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bits, 0 to 1."""
    return 1 - np.bitwise_count(a ^ b) / 64


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) with fp a signed long, one row for each row of ``docs``; null text counts as empty."""
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(simhash(texts.tolist()).view(np.int64))

    return docs.select(F.col(id_col).alias("id"), run(F.coalesce(F.col(text_col), F.lit(""))).alias("fp"))


def block_masks(radius: int = RADIUS, match: int = MATCH) -> list[int]:
    """The bits that each table is keyed by."""
    cuts = [64 * i // (radius + match) for i in range(radius + match + 1)]
    blocks = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(blocks, match)]


def within(queries: DataFrame, corpus: DataFrame, radius: int = RADIUS, match: int = MATCH) -> DataFrame:
    """Distinct (query, fp, distance) for all corpus fingerprints within ``radius`` of a query.

    Both sides have a column fp (signed long); nulls find nothing, repeats count once.
    """
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(radius, match)]

    def tables(side: DataFrame, name: str) -> DataFrame:
        keys = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("block")) for t, m in enumerate(signed)))
        return side.where("fp IS NOT NULL").select("fp").distinct().select(F.col("fp").alias(name), F.explode(keys).alias("key"))

    far = F.bit_count(F.col("query").bitwiseXOR(F.col("fp")))
    found = tables(queries, "query").join(tables(corpus, "fp"), "key").where(far <= radius)
    return found.select("query", "fp", far.alias("distance")).distinct()


def with_next(docs: DataFrame, id_col: str, text_col: str, fn, schema: str) -> DataFrame:
    """Each row with the next row by descending id (after the last: the first), streamed.

    The ids are cut into ranges, one task each, sorted inside. The first row of a range is also
    sent to the range before it, so each task sees every neighbour and holds one batch.
    ``fn(rows, nexts)`` gets lists of (id as a string, text) and returns a pandas frame of ``schema``.
    Rows of equal id are ordered by text; null ids come last.
    """
    spark, n = docs.sparkSession, tasks(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    at = F.coalesce(-F.col("id").cast("double"), F.lit(float("inf")))
    ids = docs.select(F.col(id_col).alias("id")).withColumn("at", at)
    cuts = ids.where("id IS NOT NULL").agg(F.percentile_approx("at", [i / n for i in range(1, n)] or [0.5], 10 * n)).first()[0] or []
    splits = [-float("inf"), *(sorted(set(cuts)) or [0.0]), float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="at", outputCol="range").transform
    heads = sorted((int(r["range"]), r["id"]) for r in bucketed(ids).groupBy("range").agg(F.max("id").alias("id")).collect() if r["id"] is not None)
    # one row a range: as many as shuffle partitions
    last = int(bucketed(ids).agg(F.max("range")).first()[0] or 0)
    before = {r: (heads[i - 1][0] if i else last) for i, (r, _) in enumerate(heads)}
    copies = spark.createDataFrame([(i, before[r]) for r, i in heads], f"id {dict(ids.dtypes)['id']}, before int")
    home = F.struct(F.col("range").cast("int").alias("part"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("before").alias("part"), F.lit(True).alias("copy"))
    sent = bucketed(rows.withColumn("at", at)).join(F.broadcast(copies), "id", "left").select(
        "id", "body", F.explode(F.when(F.col("before").isNull(), F.array(home)).otherwise(F.array(home, copy))).alias("to"))
    # the wrapped-around head follows everything of the last range
    wrapped = (F.col("to.copy") & (F.col("id") == (heads[0][1] if heads else None))).alias("wrapped")
    dealt = sent.select("id", "body", F.col("to.part").alias("part"), F.col("to.copy").alias("copy"), wrapped)
    dealt = dealt.repartitionById(len(splits) - 1, F.col("part")).sortWithinPartitions(
        F.coalesce("wrapped", F.lit(False)), F.desc_nulls_last("id"), "body", "copy")
    dealt = dealt.select(F.col("id").cast("string").alias("id"), "body", "copy")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = first = None
        for batch in batches:
            ours, nexts = [], []
            for i, body, copied in zip(batch["id"].tolist(), batch["body"].tolist(), batch["copy"].tolist()):
                first = first if first is not None else (i, body)
                if held is not None:
                    ours.append(held)
                    nexts.append((i, body))
                held = None if copied else (i, body)
            if ours:
                yield fn(ours, nexts)
        if held is not None:  # a table of null ids only has no head to copy
            yield fn([held], [first])

    return dealt.mapInPandas(run, schema)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of the next text."""
    tail = len(text) // 3
    return text[:len(text) - tail] + following[:tail]


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint every text and its edited text; see ``edited``.

    (id_col, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next), the fingerprints as
    signed longs. Null texts count as empty (fingerprint 0). Rows of equal id follow each other
    by text and each give a row. A single row is its own next. An empty table gives no rows.
    Other columns aren't read.
    """
    def run(rows: list, nexts: list) -> pd.DataFrame:
        changed = [edited(a, b) for (_, a), (_, b) in zip(rows, nexts)]
        chain = all(rows[i + 1] is nexts[i] or rows[i + 1] == nexts[i] for i in range(len(rows) - 1))
        if chain:  # each next is the following row: its fingerprint is needed anyway
            own = simhash([t for _, t in rows] + [nexts[-1][1]])
            own, follow = own[:-1], own[1:]
        else:
            own, follow = simhash([t for _, t in rows]), simhash([t for _, t in nexts])
        other = simhash(changed)
        return pd.DataFrame({
            id_col: [i for i, _ in rows], "n_chars": [len(t) for _, t in rows],
            "edited_sha256": [hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in changed],
            "fp": own.view(np.int64), "edited_fp": other.view(np.int64),
            "near_edited": likeness(own, other), "near_next": likeness(own, follow)})

    schema = f"{id_col} string, n_chars long, edited_sha256 string, fp long, edited_fp long, near_edited double, near_next double"
    found = with_next(docs, id_col, text_col, run, schema)
    return found.withColumn(id_col, F.col(id_col).cast(dict(docs.dtypes)[id_col]))


def document_fingerprints(docs: DataFrame, radius: int = RADIUS, every: int = 100) -> DataFrame:
    """``compare_with_edits`` plus the search: n_near counts, for the rows whose id is divisible by
    ``every``, the other rows of the table within ``radius`` bits (null for other rows)."""
    found = stored(compare_with_edits(docs), "fingerprints", wide=True)
    classes = found.groupBy("fp").agg(F.count("*").alias("size"))
    asked = found.where(F.col("doc_id") % every == 0).select("fp").distinct()
    near = within(asked, classes, radius).join(classes, "fp").groupBy("query").agg((F.sum("size") - 1).alias("n_near"))
    text = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    asks = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    answered = found.where(asks).join(near, F.col("fp") == F.col("query"), "left").drop("query")
    return answered.unionByName(found.where(~asks).withColumn("n_near", F.lit(None).cast("long"))).select(
        "doc_id", "n_chars", "edited_sha256", text("fp").alias("fingerprint"), text("edited_fp").alias("edited_fingerprint"),
        "near_edited", "near_next", "n_near")
