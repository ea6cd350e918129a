"""Runs: maximal stretches of words that repeat with a period, found by descending-LCP Kruskal.

The suffixes of a text's words are sorted (prefix doubling over the texts of a block at once;
positions whose class is a single one are settled and leave). Neighbours in that order are joined by
edges weighted with their longest common prefix (LCP). Edges are taken by decreasing LCP: a
union-find over the suffix classes keeps each class's positions in order, and when two classes
unite at LCP l, two positions i < j that become neighbours with j - i <= l seed a run of period j - i
that ends before j + l. The first such i is the run's start. No other start or period can come out: a
smaller period of the same stretch would put a position of the class between i and j.

Each text is read whole and by itself, so rows need no shuffle; a very long text takes about 200 bytes a
word in its task, and a block of short texts no more than ``BLOCK`` characters.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respawn.llm.common import others, slices

#: Shortest run, in words.
MIN_WORDS = 12
#: Characters of texts that are sorted together.
BLOCK = 1 << 20
#: A word: no ASCII white space in it (the same as ``bytes.split``).
WORD = r"[^\x20\x09-\x0D]+"
RUN = T.StructType().add("start", "long").add("length", "long").add("period", "long")
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Suffixes:
    """Suffix classes of a sequence in which every text ends with a number of its own.

    ``order`` holds the positions that share at least ``least`` symbols with another one, so that
    equal prefixes of any length are neighbours, ``lcp[e]`` the common prefix of ``order[e]``
    and ``order[e + 1]``.
    """

    def __init__(self, seq: np.ndarray, least: int) -> None:
        n = len(seq)
        rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
        self._levels, width, active = [], 1, np.arange(n)
        # rank: where the class of a position starts in the sorted order
        rank = (np.cumsum(np.bincount(rank)) - np.bincount(rank))[rank]
        while True:
            count = np.bincount(rank[active], minlength=n + 1)
            if width <= least:  # classes of single positions are settled
                active = active[count[rank[active]] > 1]
            self._levels.append(np.append(rank, n).astype(np.int32 if n < 1 << 31 else np.int64))
            unsettled = active if width <= least else active[count[rank[active]] > 1]
            if not len(unsettled):
                break
            first, second = rank[unsettled], rank[np.minimum(unsettled + width, n - 1)]
            by = np.argsort(first * (n + 1) + second, kind="stable")
            first, second, at = first[by], second[by], unsettled[by]
            new_class = np.append(True, first[1:] != first[:-1])
            new_pair = new_class.copy()
            new_pair[1:] |= second[1:] != second[:-1]
            index = np.arange(len(at))
            class_start = np.maximum.accumulate(np.where(new_class, index, 0))
            pair_start = np.maximum.accumulate(np.where(new_pair, index, 0))
            rank = rank.copy()
            rank[at] = first + pair_start - class_start
            width *= 2
        self.order = active[np.argsort(rank[active], kind="stable")]
        self.lcp = self._common(self.order[:-1], self.order[1:])

    def _common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of pairs of positions, by halving the width."""
        length = np.zeros(len(i), dtype=np.int64)
        for k in range(len(self._levels) - 1, -1, -1):
            level, end = self._levels[k], len(self._levels[k]) - 1
            a, b = np.minimum(i + length, end), np.minimum(j + length, end)
            length += np.where((level[a] == level[b]) & (a < end) & (b < end), 1 << k, 0)
        return length


def _unite(order: list[int], lcp: list[int], edges: list[int]) -> dict[tuple[int, int], int]:
    """(end, period) -> start of the runs that edges in order of decreasing LCP seed."""
    parent = list(range(len(order)))
    held: list[list[int] | None] = [[i] for i in order]
    runs: dict[tuple[int, int], int] = {}
    for e in edges:
        common = lcp[e]
        a, b = e, e + 1
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        large, small = held[a], held[b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b], held[b] = a, None
        if len(small) * 16 < len(large):
            pairs = []
            for i in small:
                at = bisect_left(large, i)
                large.insert(at, i)
            own = set(small)
            for i in small:
                at = bisect_left(large, i)
                if at and large[at - 1] not in own:
                    pairs.append((large[at - 1], i))
                if at + 1 < len(large) and large[at + 1] not in own:
                    pairs.append((i, large[at + 1]))
        else:
            own = set(small)
            held[a] = merged = sorted(large + small)
            pairs = [(i, j) for i, j in zip(merged, merged[1:]) if j - i <= common and (i in own) != (j in own)]
        for i, j in pairs:
            if j - i <= common:
                run = (j + common, j - i)
                if runs.get(run, i) >= i:
                    runs[run] = i
    return runs


def find_runs(texts: list[list[bytes]], min_words: int = MIN_WORDS) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each word list, by start, then period.

    A run has its smallest period q, length >= max(min_words, 2 q) and can't be extended.
    """
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    starts, parts, base = [], [], 0
    total = 0
    for words in texts:  # a text's words get numbers that no other text has, its end one more
        ids: dict[bytes, int] = {}
        own = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
        starts.append(total)
        parts += [own + base, [base + len(ids)]]
        base += len(ids) + 1
        total += len(words) + 1
    if not total:
        return out
    least = max(1, -(-min_words // 2))  # the first seed of a run has an LCP of at least half the run
    found = Suffixes(np.concatenate(parts).astype(np.int64), least)
    edges = np.flatnonzero(found.lcp >= least)
    edges = edges[np.argsort(-found.lcp[edges], kind="stable")]
    runs = _unite(found.order.tolist(), found.lcp.tolist(), edges.tolist())
    for (end, period), start in runs.items():
        if end - start >= max(min_words, 2 * period):
            text = int(np.searchsorted(starts, start, "right")) - 1
            out[text].append((start - starts[text], end - start, period))
    for own in out:
        own.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


def periodic_runs(docs: DataFrame, text_col: str = "text", min_words: int = MIN_WORDS, prefix: str = "") -> DataFrame:
    """``docs`` plus runs (array of start, length, period in words) and collapsed (text, one period of each run kept).

    ``prefix`` is put before the new names; columns that already have those names are replaced.

    All rows stay, each read by itself: repeated rows and ids, null ids and other columns don't matter.
    Null texts and texts without words have no runs and collapse to the empty text. Words
    are compared byte for byte; ``collapsed`` joins them by one space whether or not a run was found.
    An empty table gives no rows.
    """
    new = (f"{prefix}runs", f"{prefix}collapsed")
    kept = others(docs, *new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            for part in slices(texts, BLOCK):
                split = [t.encode().split() for t in texts[part]]
                runs = find_runs(split, min_words)
                spans = [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs]
                short = [b" ".join(collapse(words, own)).decode() for words, own in zip(split, runs)]
                rows = batch.slice(part.start, part.stop - part.start)
                new_columns = [pa.array(spans, SPANS), pa.array(short, pa.string())]
                yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in kept), *new_columns], [*kept, *new])

    schema = T.StructType([docs.schema[c] for c in kept]).add(new[0], T.ArrayType(RUN)).add(new[1], "string")
    return docs.select(*kept, *([] if text_col in kept else [text_col])).mapInArrow(run, schema)


def stretched(text: Column, doc_id: Column) -> Column:
    """The query's text: every tenth document (by the CRC of its id) repeats its words periodically from some word on.

    With h the CRC, g = h div 10 and n words, each word i >= a = g mod n becomes word a + (i - a) mod p,
    p = 1 + (n - a) div (3 + g mod 8). Other texts, and those without id or words, stay.
    """
    crc = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(crc / F.lit(10)).cast("long")
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))

    def periodic(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8)))).cast("long")
        place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(w, place(i).cast("int"))), " ")

    some = (F.pmod(crc, F.lit(10)) == 0) & text.rlike(WORD)
    # a one-element array names the words, so that they are split once
    return F.when(some, F.get(F.transform(F.array(words), periodic), F.lit(0))).otherwise(text)


def run_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id_col, n_runs, the longest run's figures, runs_sha256, collapsed_sha256.

    Ties for the longest run go to the smallest start, then period; a document without runs has
    nulls there. The cases of ``periodic_runs`` hold.
    """
    text = stretched(F.col(text_col), F.col(id_col))
    rows = periodic_runs(docs.select(id_col, text.alias("__words")), "__words")
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))
    longest = F.get(F.array_sort(ranked), F.lit(0))
    rows = rows.withColumn("longest", longest)
    lines = F.array_join(F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"])), "")
    length, period = -F.col("longest.shorter"), F.col("longest.period")
    return rows.select(
        id_col, F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), length.alias("length"),
        period.alias("period"), F.floor(F.lit(1000) * length / period).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
