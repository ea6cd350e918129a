"""Split rows into overlapping shards of bounded size by trees fitted on samples.

The loop behind the vantage-point trees and the projection trees: while some shard holds more
than ``cap`` rows, a tree is fitted on a bounded sample of each such shard (one task a shard),
and all its rows are routed down that tree into child shards. The depth follows the data, the
model of a shard doesn't: a shard of any size costs one bounded sample and one pass.
Rows move packed, those of a shard that a task has at hand in one row, and a model joins these: it
comes once for thousands of rows, not beside each. The join is salted over ``SALTS`` copies, so one
huge shard is read by many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from respawn.llm.common import TASK_BYTES, bytes_read, stored

SALTS = 64
#: Rows that a task packs at once.
HELD = 1 << 15


def refine(rows: DataFrame, point: str, fit: Callable[[str, np.ndarray, int], bytes | None],
           route: Callable[[bytes, np.ndarray], Iterator[tuple[int, np.ndarray]]], cap: int, sample: int) -> DataFrame:
    """Split until each shard holds at most ``cap`` rows or can't be split.

    ``rows`` has the columns shard (string), id (long) and ``point``. ``fit(shard, points, n)``
    gets at most ``sample`` points of a shard of ``n`` rows and returns a model, or None if no
    split helps. ``route(model, points)`` yields (leaf, row indexes); a row may go to several
    leaves. Returns the same columns.
    """
    kind = dict(rows.dtypes)[point]
    schema = f"shard string, id long, {point} {kind}, done boolean"

    def fitted(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        model = fit(key[0], _points(pdf[point]), int(key[1]))
        return pd.DataFrame({"shard": [key[0]], "model": [model]})

    number = np.dtype({"bigint": "int64", "float": "float32", "double": "float64"}[kind.removeprefix("array<").removesuffix(">")])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def rows() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            names = table["shard"].combine_chunks().dictionary_encode()
            code, ids, points = names.indices.to_numpy(), table["id"].to_numpy(), table[point].combine_chunks()
            order = np.argsort(code, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(code[order]) != 0, True])
            own = [order[lo:hi] for lo, hi in zip(cuts, cuts[1:])]
            flat = [_flat(points.take(pa.array(at))).tobytes() for at in own]
            return pa.RecordBatch.from_arrays(
                [names.dictionary.take(pa.array([int(code[at[0]]) for at in own])), pa.array([int(ids[at[0]]) * 0x9E3779B97F4A7C15 % (1 << 64) * SALTS >> 64 for at in own], pa.int32()),
                 pa.array([ids[at].tobytes() for at in own], pa.binary()), pa.array(flat, pa.binary())], ["shard", "salt", "ids", "points"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= HELD:
                yield rows()
                held.clear()
        if any(b.num_rows for b in held):
            yield rows()

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, ids, points, model = (batch.column(c)[i].as_py() for c in ("shard", "ids", "points", "model"))
                ids, points = np.frombuffer(ids, dtype=np.int64), np.frombuffer(points, dtype=number)
                points = points.reshape(len(ids), -1) if kind.startswith("array") else points
                leaves = [(shard, np.arange(len(ids)))] if model is None else [(f"{shard}.{leaf}", at) for leaf, at in route(model, points)]
                for lo in range(0, len(leaves), 64):
                    names, own = zip(*leaves[lo:lo + 64])
                    at = np.concatenate(own)
                    code = np.repeat(np.arange(len(names), dtype=np.int32), [len(x) for x in own])
                    values = pa.array(points[at].ravel())
                    if kind.startswith("array"):
                        values = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * points.shape[1]), values)
                    yield pa.RecordBatch.from_arrays([pa.array(names).take(pa.array(code)), pa.array(ids[at]), values, pa.array(np.full(len(at), model is None))],
                                                     ["shard", "id", point, "done"])

    spark = rows.sparkSession
    few = 2 * spark.sparkContext.defaultParallelism
    finished, open_rows = [], stored(rows.select("shard", "id", point, F.lit(False).alias("done")), "shards")
    while True:
        sizes = stored(open_rows.where("not done").groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > cap), "sizes")
        finished.append(open_rows.join(sizes, "shard", "left_anti"))
        if sizes.isEmpty():
            break
        big = open_rows.where("not done").join(sizes.select("shard", "n"), "shard")
        rate = F.lit(4.0 * sample) / F.col("n")
        order = F.xxhash64("id", F.lit("sample"))
        drawn = big.where((F.pmod(F.xxhash64("shard", "id"), F.lit(1 << 30)) / F.lit(float(1 << 30))) < rate)
        drawn = drawn.withColumn("k", F.row_number().over(W.partitionBy("shard").orderBy(order, "id"))).where(F.col("k") <= sample)
        models = stored(drawn.groupBy("shard", "n").applyInPandas(fitted, "shard string, model binary"), "models")
        salted = models.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        chunks = open_rows.where("not done").join(sizes.select("shard"), "shard", "left_semi").select("shard", "id", point)
        chunks = chunks.mapInArrow(packed, "shard string, salt int, ids binary, points binary")
        if bytes_read(open_rows) < few * TASK_BYTES:  # small files are read by a few tasks
            chunks = chunks.repartition(few)
        chunks = chunks.join(salted.drop("n"), ["shard", "salt"])
        open_rows = stored(chunks.select("shard", "ids", "points", "model").mapInArrow(routed, schema), "shards")
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.select("shard", "id", point)


def _flat(points: pa.Array) -> np.ndarray:
    """The numbers of a column of numbers or lists, one after the other."""
    return (points.flatten() if pa.types.is_list(points.type) else points).to_numpy(zero_copy_only=False)


def _points(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if column.dtype == object else column.to_numpy()
