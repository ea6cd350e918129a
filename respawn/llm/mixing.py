"""Mixing sources to target weights by Poisson replication, in DataFrame operations only.

A source's mean repetition rate is its share of the target over its share of the input (shares of
characters). Each document inverts the Poisson distribution of its source's rate at a number
that a seeded hash of its id gives, is exploded into that many copies, and all copies are dealt
out and sorted by a second seeded hash. The same ids give the same copies on any cluster.

A rate above ``STEP`` is cut into equal parts whose counts add up (a sum of Poisson counts is one),
so the distribution function stays a short array without underflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respawn.llm.common import stored, tasks

SEED = "mix"
STEP = 32.0
#: Sources up to which the rates (at most 2 KB a source) are broadcast; beyond it the join is salted.
BROADCAST_SOURCES = 10_000
SALTS = 64


def unit_hash(*parts: Column) -> Column:
    """A double in [0, 1) from the first 52 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson_cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ... until the rest can't be told from 0 at 52 bits."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    first = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), last), first, step)["cdf"]


def source_masses(docs: DataFrame, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(source, mass): characters of each source; null is a source of its own."""
    return docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(F.coalesce(F.length(text_col), F.lit(0)).cast("long")).alias("mass"))


def root_weights(masses: DataFrame) -> DataFrame:
    """Targets between proportional and equal: the whole part of the root of a source's mass."""
    return masses.select("source", F.floor(F.sqrt("mass")).cast("long").alias("weight"))


def rates(masses: DataFrame, weights: DataFrame, epochs: float = 1.0) -> DataFrame:
    """(source, rate): how often a document of the source should appear on average.

    ``epochs`` is the size of the mix over that of the input. Sources without a weight, or with
    a null or non-positive one, get rate 0. A source without characters gets rate 1.
    """
    known = masses.alias("m").join(weights.alias("w"), F.col("m.source").eqNullSafe(F.col("w.source")), "left").select(
        "m.source", "mass", F.greatest(F.coalesce("weight", F.lit(0)), F.lit(0)).alias("weight"))
    total = lambda c: known.agg(F.sum(c)).scalar().cast("double")
    share = F.col("weight").cast("double") / total("weight") * (total("mass") * epochs) / F.col("mass").cast("double")
    rate = F.when(F.col("mass") == 0, F.lit(1.0)).when(F.col("weight") == 0, F.lit(0.0)).otherwise(share)
    return known.select("source", rate.alias("rate"))


def mix(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0, seed: str = SEED, id_col: str = "doc_id",
        source_col: str = "source", text_col: str = "text", prefix: str = "") -> DataFrame:
    """The mix: all columns of ``docs`` plus copy (0, 1, ...) and shuffle_key, its order.

    ``prefix`` is put before the new names; columns that already have those names are replaced.

    ``weights`` is (source, weight), by default ``root_weights``. Rows with equal ids are copied
    equally often (rows with a null id go by the hash of their text). Null texts have mass 0.
    Partitions hold random rows, sorted by shuffle_key (ties by id and copy); an empty
    table gives no rows.
    """
    masses = stored(source_masses(docs, source_col, text_col), "masses")
    table = rates(masses, root_weights(masses) if weights is None else weights, epochs)
    parts = F.ceil(F.col("rate") / STEP).cast("int")
    table = table.withColumn("parts", parts).withColumn("__step", F.when(parts > 0, F.col("rate") / parts).otherwise(F.lit(0.0)))
    table = stored(table.select(F.col("source").alias("__source"), F.col("parts").alias("__parts"), poisson_cdf(F.col("__step")).alias("__cdf")), "rates")

    key = F.coalesce(F.col(id_col).cast("string"), F.md5(F.col(text_col).cast("binary")), F.lit(""))
    same = F.col(source_col).eqNullSafe(F.col("__source"))
    if table.count() <= BROADCAST_SOURCES:
        known = docs.join(F.broadcast(table), same)
    else:
        salted = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        known = docs.withColumn("__deal", F.pmod(F.xxhash64(id_col), F.lit(SALTS)).cast("int")).join(
            salted, same & (F.col("__deal") == F.col("__salt"))).drop("__deal", "__salt")

    def part(total: Column, j: Column) -> Column:
        u = unit_hash(F.lit(seed), key, j.cast("string"))
        return total + F.size(F.filter("__cdf", lambda c: c <= u))

    times = F.when(F.col("__parts") > 0, F.aggregate(F.sequence(F.lit(1), F.col("__parts")), F.lit(0), part)).otherwise(F.lit(0))
    counted = known.withColumn("__times", times).where("__times > 0").drop("__cdf", "__parts", "__source")
    copy, place = f"{prefix}copy", f"{prefix}shuffle_key"
    copies = counted.withColumn(copy, F.explode(F.sequence(F.lit(0), F.col("__times") - 1))).drop("__times")
    order = F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), key, F.col(copy).cast("string"))), 1, 16)
    return copies.withColumn(place, order).repartition(tasks(docs.sparkSession), place).sortWithinPartitions(place, id_col, copy)


#: The query's mix in DuckDB: the same hashes, weights and distribution function.
ORACLE_SQL = f"""
WITH RECURSIVE masses AS (SELECT source, sum(length(coalesce(text, '')))::BIGINT AS mass FROM documents GROUP BY source),
weights AS (SELECT source, mass, floor(sqrt(mass))::BIGINT AS weight FROM masses),
rates AS (
  SELECT source, CASE WHEN mass = 0 THEN 1.0::DOUBLE WHEN weight = 0 THEN 0.0::DOUBLE ELSE
    weight::DOUBLE / (SELECT sum(weight) FROM weights)::DOUBLE * ((SELECT sum(mass) FROM weights)::DOUBLE * 1.0::DOUBLE) / mass::DOUBLE END AS rate FROM weights),
parts AS (SELECT source, rate, ceil(rate / {STEP}::DOUBLE)::INT AS parts FROM rates),
steps AS (SELECT source, parts, rate / parts AS step, ceil(rate / parts + 12 * sqrt(rate / parts) + 24)::INT AS k_last FROM parts WHERE parts > 0),
cdf AS (
  SELECT source, 0 AS k, exp(-step) AS p, exp(-step) AS c FROM steps
  UNION ALL
  SELECT cdf.source, k + 1, p * step / (k + 1), c + p * step / (k + 1) FROM cdf JOIN steps ON cdf.source IS NOT DISTINCT FROM steps.source WHERE k < k_last),
cdfs AS (SELECT source, list(c ORDER BY k) AS cs FROM cdf GROUP BY source),
draws AS (
  SELECT d.*, coalesce(doc_id::VARCHAR, md5(text), '') AS id_key, s.parts, cs FROM documents d
  JOIN steps s ON d.source IS NOT DISTINCT FROM s.source JOIN cdfs ON d.source IS NOT DISTINCT FROM cdfs.source),
counted AS (
  SELECT *, list_sum(list_transform(generate_series(1, parts), lambda j: len(list_filter(cs, lambda c: c <=
    ('0x' || substr(md5('{SEED}:' || id_key || ':' || j::VARCHAR), 1, 13))::BIGINT::DOUBLE / {float(1 << 52)}::DOUBLE))))::BIGINT AS times FROM draws),
copies AS (SELECT doc_id, text, lang, source, n_chars, id_key, unnest(generate_series(0, times - 1))::INT AS copy FROM counted WHERE times > 0)
SELECT doc_id, text, lang, source, n_chars, copy, substr(md5('{SEED}:order:' || id_key || ':' || copy::VARCHAR), 1, 16) AS shuffle_key FROM copies
"""
