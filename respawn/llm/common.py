"""Helpers the training-data operators share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from respawn.session import checkpoint_dir


def scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/respawn-llm/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path inside the cluster's shared folder (``spark.checkpoint.dir``)."""
    return f"{scratch_root(spark)}/{uuid.uuid4().hex}/{name}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application's operators stored; call it once their results are written."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


#: Bytes of input for each task that writes a table of ids, edges or counts.
TASK_BYTES = 64 << 20
#: Whether a query's shuffle files are removed at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, wide: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor rereads files every node can see. Tables of ids, edges and
    counts are written by a task for each ``TASK_BYTES`` of the files that the step reads, ``2 x cores`` at least, so a step
    of an iteration doesn't leave a file for each shuffle partition and tasks don't grow with the data; ``wide``
    tables (texts, or a row for each line) by as many tasks as they have partitions. Shuffle files of the step go when
    it has ended, not only when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    if not wide:
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, bytes_read(df) // TASK_BYTES))
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    return spark.read.parquet(path)


def bytes_read(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads (as often as it reads them)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = (leaf for leaf in (leaves.apply(i) for i in range(leaves.size())) if leaf.getClass().getSimpleName() == "LogicalRelation")
    return sum(int(str(leaf.stats().sizeInBytes())) for leaf in files)


def others(df: DataFrame, *names: str) -> list[str]:
    """The columns of ``df`` that none of the new ``names`` replaces (names ignore case, as in Spark)."""
    return [c for c in df.columns if c.lower() not in {n.lower() for n in names}]


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(texts: list[str], most: int) -> Iterator[slice]:
    """Cut a list of texts where about ``most`` characters are reached (one text at least)."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held > most:
            yield slice(lo, i + 1)
            lo, held = i + 1, 0
    if lo < len(texts):
        yield slice(lo, len(texts))


#: Hashes whose bits are unpacked at once: few enough to stay in a core's cache.
BIT_BLOCK = 1 << 11


def bit_counts(hashes: np.ndarray, starts: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Per group and bit, how many hashes (or how much weight, in whole numbers) set that bit.

    ``hashes`` is uint64; group ``g`` is ``hashes[starts[g]:starts[g + 1]]`` and must not be
    empty. Column 0 of the (groups, 64) result is the most significant bit.
    """
    out = np.zeros((len(starts) - 1, 64), dtype=np.int64)
    for lo in range(0, len(hashes), BIT_BLOCK):
        hi = min(len(hashes), lo + BIT_BLOCK)
        bits = np.unpackbits(hashes[lo:hi].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        if weights is not None:
            bits = bits * weights[lo:hi, None].astype(np.int32)
        first = int(np.searchsorted(starts, lo, "right")) - 1
        last = int(np.searchsorted(starts[:-1], hi, "left"))
        cuts = np.maximum(starts[first:last], lo) - lo
        out[first:last] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int32)
    return out


def pack_bits(bits: np.ndarray) -> np.ndarray:
    """(n, 64) booleans, most significant first -> uint64."""
    return np.packbits(bits, axis=1).view(">u8").reshape(-1).astype(np.uint64)
