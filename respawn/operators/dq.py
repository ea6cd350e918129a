"""Declarative data-quality expectations.

A rule is ``(name, SQL predicate, action)`` with action ``drop`` (remove failing
rows), ``warn`` (keep them, count them) or ``fail`` (stop the job). Rules are
three-valued-safe: only a predicate that is TRUE passes (counts use
``coalesce(p, false)``, filters drop NULL anyway), so a NULL comparison counts as a failure.

Pass/fail counts are taken in the *same pass* as the data with
``DataFrame.observe`` -- no second scan, no driver-side loop -- and surface
either through a :class:`pyspark.sql.Observation` (batch) or through
``StreamingQueryProgress.observedMetrics`` (streams). For a durable metrics
table, :func:`rule_metrics` computes all rules of a dataset in one global
aggregate (partial aggregation on every executor, one tiny shuffle) and
unpivots it with ``stack``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from respawn.constants import EVENT_TYPES, GAME_MODES, PLATFORMS, REGIONS

DROP, WARN, FAIL = "drop", "warn", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: str
    action: str = DROP

    def passes(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


def _in(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ---------------------------------------------------------------------------
# Rule catalogue of the pipeline (names, predicates and actions are part of the
# contract and appear in metrics).
# ---------------------------------------------------------------------------
RAW_RULES = [
    Rule("valid_event_id", "event_id IS NOT NULL"),
    Rule("valid_player_id", "player_id IS NOT NULL"),
    Rule("valid_event_type", f"event_type IN ({_in(EVENT_TYPES)})"),
]
RAW_RULES_NORMALIZED = [
    RAW_RULES[0], RAW_RULES[1],
    Rule("valid_event_type", f"lower(trim(event_type)) IN ({_in(EVENT_TYPES)})"),
]
CLEANED_RULES = [
    Rule("valid_event_id", "event_id IS NOT NULL"),
    Rule("valid_player_id", "player_id IS NOT NULL"),
    Rule("valid_event_type", f"event_type_normalized IN ({_in(EVENT_TYPES)})"),
    Rule("known_game_mode", f"game_mode IS NULL OR game_mode IN ({_in(GAME_MODES)})", WARN),
    Rule("known_region", f"region IS NULL OR region IN ({_in(REGIONS)})", WARN),
    Rule("known_platform", f"platform IS NULL OR platform IN ({_in(PLATFORMS)})", WARN),
]
SESSION_RULES = [
    Rule("valid_session_id", "session_id IS NOT NULL"),
    Rule("valid_player_id", "player_id IS NOT NULL"),
    Rule("positive_duration", "duration_min > 0"),
    Rule("non_negative_kills", "kills >= 0", WARN),
    Rule("non_negative_deaths", "deaths >= 0", WARN),
]
# A price must be finite and fit the money type; NaN and Infinity compare above every number.
VALID_PRICE = "item_price_usd IS NOT NULL AND item_price_usd >= 0 AND item_price_usd < 1e16"
PURCHASE_RULES = [
    Rule("valid_purchase_amount", VALID_PRICE),
]
CHURN_RULES = [
    Rule("valid_player_id", "player_id IS NOT NULL"),
    Rule("valid_compute_date", "compute_date IS NOT NULL"),
]
ARPU_RULES = [
    Rule("valid_player_id", "player_id IS NOT NULL"),
]

CATALOGUE = {
    "raw_events": RAW_RULES,
    "player_events_cleaned": CLEANED_RULES,
    "player_sessions": SESSION_RULES,
    "player_purchase_events": PURCHASE_RULES,
    "churn_features_daily": CHURN_RULES,
    "arpu_features_daily": ARPU_RULES,
}


def expect(df: DataFrame, rules: list[Rule], observation: Observation | str | None = None,
           flag_column: str | None = None) -> DataFrame:
    """Apply ``rules`` to ``df``.

    * ``drop`` rules filter, ``warn`` rules only count, ``fail`` rules raise.
    * ``observation`` (an Observation, or a name for streaming) receives
      ``rows`` and one ``<rule>_failed`` count per rule, measured on the input
      rows in the same pass.
    * ``flag_column`` optionally keeps an ``array<string>`` of failed warn rules.
    """
    if not rules:
        return df
    out = df
    if observation is not None:
        metrics = [F.count(F.lit(1)).alias("rows")]
        for r in rules:
            metrics.append(F.count_if(~r.passes()).alias(f"{r.name}_failed"))
        out = out.observe(observation, *metrics)
    for r in rules:
        if r.action == FAIL:
            # A filter that is always true but raises on the first violating row
            # (a projection would be pruned away by the optimizer).
            out = out.where(F.when(~r.passes(), F.raise_error(
                F.lit(f"expectation {r.name} failed: {r.predicate}"))).otherwise(F.lit(True)))
    if flag_column:
        warn = [r for r in rules if r.action == WARN]
        out = out.withColumn(
            flag_column,
            F.filter(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in warn]),
                     lambda x: x.isNotNull()) if warn else F.array().cast("array<string>"),
        )
    drop = [r for r in rules if r.action == DROP]
    for r in drop:  # a filter drops NULL as it drops FALSE, so the bare predicate can reach the scan
        out = out.where(F.expr(r.predicate))
    return out


def expect_or_drop(df: DataFrame, name: str, predicate: str, observation=None) -> DataFrame:
    return expect(df, [Rule(name, predicate, DROP)], observation)


def expect_warn(df: DataFrame, name: str, predicate: str, observation=None) -> DataFrame:
    return expect(df, [Rule(name, predicate, WARN)], observation)


def expect_or_fail(df: DataFrame, name: str, predicate: str, observation=None) -> DataFrame:
    return expect(df, [Rule(name, predicate, FAIL)], observation)


def observed_counts(observation: Observation, rules: list[Rule], dataset: str) -> list[dict]:
    """Rows of (dataset, rule, action, total, passed, failed) from a finished Observation."""
    got = observation.get
    total = int(got["rows"])
    out = []
    for r in rules:
        failed = int(got[f"{r.name}_failed"])
        out.append({"dataset": dataset, "rule": r.name, "action": r.action,
                    "total": total, "passed": total - failed, "failed": failed})
    return out


def rule_metrics(df: DataFrame, rules: list[Rule], dataset: str) -> DataFrame:
    """One row per rule: dataset, rule, action, total, passed, failed, pass_pct (see :func:`rule_metrics_of`)."""
    return rule_metrics_of(df, [(dataset, rules, F.lit(True))])


def rule_metrics_of(df: DataFrame, parts: list[tuple[str, list[Rule], Column]]) -> DataFrame:
    """The rules of several datasets that are rows of one table, each told by a condition, in one pass.

    One global aggregate over ``df`` (map-side partial counts), then ``stack``.
    ``pass_pct`` is half-up rounded to 2 decimals with integer arithmetic.
    """
    aggs, rows = [], []
    for k, (dataset, rules, own) in enumerate(parts):
        own = F.coalesce(own, F.lit(False))
        aggs.append(F.count_if(own).alias(f"_t{k}"))
        for i, r in enumerate(rules):
            aggs.append(F.count_if(own & ~r.passes()).alias(f"_f{k}_{i}"))
            rows.append(f"'{dataset}', '{r.name}', '{r.action}', _t{k}, _f{k}_{i}")
    long = df.agg(*aggs).selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS (dataset, rule, action, _total, failed)")
    total = F.col("_total")
    from respawn.functions.exact import ratio_round
    return long.select(
        "dataset", "rule", "action",
        total.cast("long").alias("total"),
        (total - F.col("failed")).cast("long").alias("passed"),
        F.col("failed").cast("long").alias("failed"),
        ratio_round((total - F.col("failed")) * F.lit(100), total, 2).alias("pass_pct"),
    )
