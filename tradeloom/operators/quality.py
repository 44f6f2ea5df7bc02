"""Declared data-quality expectations: warn, drop, fail, quarantine, metrics, de-duplication.

A rule is a SQL condition over the job's output.  *drop* keeps the rows whose condition is TRUE, so
an unknown (NULL) condition drops the row.  *warn* and *fail* count only rows whose condition is
FALSE.  All rules of a table are evaluated together in one pass, never with one count per rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str = DROP

    def violated(self) -> Column:
        holds = F.expr(self.condition)
        if self.action == DROP:
            return ~F.coalesce(holds, F.lit(False))
        return F.coalesce(~holds, F.lit(False))


@dataclass(frozen=True)
class Checked:
    good: DataFrame
    quarantined: DataFrame
    metrics: DataFrame


def of_action(rules: Sequence[Rule], action: str) -> list[Rule]:
    return [r for r in rules if r.action == action]


def keep_valid(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that pass every drop rule; a fail rule that is violated aborts the job."""
    out = df
    for rule in of_action(rules, DROP):
        out = out.filter(F.expr(rule.condition))
    return expect_or_fail(out, of_action(rules, FAIL))


def expect_or_drop(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return keep_valid(df, [Rule(r.name, r.condition, DROP) for r in rules])


def expect_or_fail(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Raise inside the running job as soon as one row violates a rule; no separate count."""
    out = df
    for rule in rules:
        message = F.lit(f"expectation failed: rule='{rule.name}', condition='{rule.condition}'")
        violated = Rule(rule.name, rule.condition, FAIL).violated()
        out = out.filter(
            F.when(violated, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
        )
    return out


def expect_warn(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Observation]:
    """Keep every row and count violations of any kind of rule while the rows flow by.

    The observation holds one number per rule, plus ``rows``, once an action on the frame ran.
    """
    observation = Observation()
    counts = [F.count_if(r.violated()).alias(r.name) for r in rules]
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), *counts), observation


def observed_metrics(observation: Observation, rules: Sequence[Rule]) -> list[tuple]:
    """Rows (rule, condition, action, violations, checked rows) of a finished observation."""
    seen = observation.get
    return [(r.name, r.condition, r.action, seen[r.name], seen["rows"]) for r in rules]


def failed_rules(rules: Sequence[Rule]) -> Column:
    """Names of the rules a row violates."""
    return F.array_compact(F.array(*[F.when(r.violated(), F.lit(r.name)) for r in rules]))


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that a drop rule rejects, with the names of the rules they fail."""
    names = failed_rules(of_action(rules, DROP))
    return df.withColumn("failed_rules", names).filter(F.size("failed_rules") > 0)


def expectation_metrics(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """One row per rule with its number of violations, from a single aggregate over the table."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(r.violated()).alias(f"_v{i}") for i, r in enumerate(rules)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.condition).alias("condition"),
                F.lit(r.action).alias("action"),
                F.col(f"_v{i}").alias("violations"),
                F.col("_rows").alias("checked_rows"),
            )
            for i, r in enumerate(rules)
        ]
    )
    return counts.select(F.lit(table).alias("table_name"), F.inline(entries))


def check(df: DataFrame, rules: Sequence[Rule], table: str) -> Checked:
    return Checked(
        good=keep_valid(df, rules),
        quarantined=quarantine(df, rules),
        metrics=expectation_metrics(df, rules, table),
    )


def dq_metrics(metrics: DataFrame, run_id: str, as_of: Column | None = None) -> DataFrame:
    """Rows for the per-rule history table: pass and fail counts of one run."""
    return metrics.select(
        F.lit(run_id).alias("run_id"),
        (F.current_timestamp() if as_of is None else as_of).alias("checked_at"),
        "table_name",
        "rule",
        "action",
        (F.col("checked_rows") - F.col("violations")).alias("passed"),
        F.col("violations").alias("failed"),
    )


def drift(history: DataFrame, run_id: str, tolerance: float = 0.01) -> DataFrame:
    """Failed share of every rule in a run against the run before it.

    ``verdict`` is ``NEW`` for a rule without an earlier run, ``WORSE`` or ``BETTER`` where the share moved
    by more than the tolerance, else ``SAME``.  Runs are ordered by the time of their check.
    """
    share = F.try_divide(F.col("failed").cast("double"), (F.col("passed") + F.col("failed")).cast("double"))
    rows = history.withColumn("failed_share", F.coalesce(share, F.lit(0.0)))
    runs = Window.partitionBy("table_name", "rule").orderBy("checked_at", "run_id")
    seen = rows.withColumn("before_share", F.lag("failed_share").over(runs)).where(F.col("run_id") == run_id)
    moved = F.col("failed_share") - F.col("before_share")
    verdict = (
        F.when(moved.isNull(), "NEW").when(moved > tolerance, "WORSE").when(moved < -tolerance, "BETTER").otherwise("SAME")
    )
    return seen.select("table_name", "rule", "failed", "failed_share", "before_share", verdict.alias("verdict"))


def deduplicate(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per key, the newest by the given columns.

    ``max_by`` aggregates, so copies of a key collapse before the shuffle and a key with very
    many copies never meets in one task, as it would under ``row_number()``.
    """
    order = F.struct(*[F.col(c) for c in newest_first])
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(*keys).agg(F.max_by(row, order).alias("_row")).select("_row.*")
