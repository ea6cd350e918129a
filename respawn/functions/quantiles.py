"""Exact quantiles and the area under the ROC curve, without gathering values in one task.

A quantile takes two passes. The first is a mergeable sketch (``percentile_approx``: Greenwald-Khanna, whose rank
error has a bound) that brackets each wanted rank by two values. The second counts what lies below a
bracket and, value by value, what lies inside: about 1 / ``BRACKETS`` of the rows for each quantile. The sketch
moves work, never the result: a rank outside its bracket would be an error, not another value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A bracket holds about this share of the rows (one part of); the sketch is five times as fine.
BRACKETS = 2_000
#: Ranges that distinct scores are ranked in.
BUCKETS = 1_000


def exact_quantiles(df: DataFrame, value: str, shares: list[float]) -> Column:
    """Scalar array: for each share p the smallest value with at least p of the rows at or below it.

    NULLs and NaNs don't count; the array is NULL if nothing else is there. ``df`` is read twice.
    """
    v = F.col(value)
    rows = df.where(v.isNotNull() & ~F.isnan(v)).select(v.cast("double").alias("v"))
    half, asc = 0.5 / BRACKETS, sorted(shares)
    steps = [x for p in asc for x in (max(0.0, p - half), min(1.0, p + half))]
    ends = rows.agg(F.percentile_approx("v", steps, 10 * BRACKETS)).scalar()
    low = [F.lit(float("-inf")) if p - half <= 0 else F.get("ends", F.lit(2 * i)) for i, p in enumerate(asc)]
    high = [F.lit(float("inf")) if p + half >= 1 else F.get("ends", F.lit(2 * i + 1)) for i, p in enumerate(asc)]
    # brackets in order: a value has begun the first ``begun`` of them and is behind the first ``past``
    begun = sum((F.when(F.col("v") >= x, 1).otherwise(0) for x in low), F.lit(0))
    past = sum((F.when(F.col("v") > x, 1).otherwise(0) for x in high), F.lit(0))
    placed = rows.withColumn("ends", ends).select("v", begun.alias("begun"), past.alias("past"))
    counts = placed.groupBy("begun", "past", F.when(F.col("begun") > F.col("past"), F.col("v")).alias("inside")).agg(F.count(F.lit(1)).alias("n"))
    asked = F.explode(F.array(*[F.struct(F.lit(shares.index(p)).alias("i"), F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in enumerate(asc)])).alias("q")
    each = counts.select("begun", "past", "inside", "n", asked).select("begun", "past", "inside", "n", "q.*")
    own = F.when((F.col("begun") > F.col("k")) & (F.col("past") <= F.col("k")), F.col("inside"))
    # a row a value inside a quantile's bracket, and one for all outside
    small = each.groupBy("i", "p", own.alias("v")).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("begun") <= F.col("k"), F.col("n")).otherwise(F.lit(0))).alias("below"))
    whole = Window.partitionBy("i")
    upto = whole.orderBy(F.col("v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = small.select("i", "p", "v", F.sum("n").over(whole).alias("rows"), F.max(F.when(F.col("v").isNull(), F.col("below"))).over(whole).alias("below"),
                           F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(F.lit(0))).over(upto).alias("upto"))
    rank = F.greatest(F.lit(1), F.col("rows") - F.floor(F.col("rows") - F.col("p") * F.col("rows")))
    seen = F.coalesce(F.col("below"), F.lit(0)) + F.col("upto")
    found = counted.groupBy("i").agg(
        F.min(F.when(F.col("v").isNotNull() & (seen >= rank), F.col("v"))).alias("v"),
        F.max(F.coalesce(F.col("below"), F.lit(0)) < rank).alias("held"))
    checked = F.when(F.col("held") & F.col("v").isNotNull(), F.col("v")).otherwise(F.raise_error(F.lit("a quantile's rank lies outside its bracket")).cast("double"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("i", checked.alias("v")))), lambda x: x["v"])
    return found.agg(F.when(F.count(F.lit(1)) > 0, ordered)).scalar()


def auc(df: DataFrame, score: str, label: str) -> Column:
    """Scalar double: the area under the ROC curve, the share of (positive, negative) pairs in which the positive's score is
    higher, ties counting half.

    Rows without a score (or NaN) or label don't count; NULL if one class is missing. Distinct scores are counted by class first
    and summed up in two levels: ranges of scores (their totals are a row each), then scores within a range. All sums
    are whole numbers, so the result is one division of exact operands on any partitioning.
    """
    s, y = F.col(score), F.col(label)
    counts = df.where(s.isNotNull() & ~F.isnan(s) & y.isNotNull()).groupBy(s.cast("double").alias("s")).agg(
        F.count_if(y == 1).alias("p"), F.count_if(y != 1).alias("n"))
    cuts = counts.agg(F.percentile_approx("s", [i / BUCKETS for i in range(1, BUCKETS)], 10 * BUCKETS)).scalar()
    ranged = counts.withColumn("cuts", cuts).select("s", "p", "n", F.size(F.filter("cuts", lambda c: c < F.col("s"))).alias("range"))
    whole = "decimal(38,0)"
    times = lambda a, b: (a.cast("decimal(19,0)") * b.cast("decimal(19,0)")).cast(whole)
    inner = Window.partitionBy("range").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    under = F.coalesce(F.sum("n").over(inner), F.lit(0))
    ranges = ranged.select("range", "p", "n", under.alias("under")).groupBy("range").agg(
        F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum(times(F.col("p"), 2 * F.col("under") + F.col("n"))).alias("inner"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    placed = ranges.select("p", "n", "inner", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    one = placed.agg(F.sum("p").alias("p"), F.sum("n").alias("n"), F.sum(F.col("inner") + times(F.col("p"), 2 * F.col("before"))).alias("twice"))
    pairs = times(F.col("p"), F.col("n")) * F.lit(2).cast("decimal(1,0)")
    return one.select(F.when((F.col("p") > 0) & (F.col("n") > 0), F.col("twice").cast("double") / pairs.cast("double"))).scalar()
