"""Row expectations: SQL conditions a row should meet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

FAILED, QUARANTINED = "failed_rules", "quarantined"


@dataclass(frozen=True)
class Rule:
    """``condition`` must be true; null counts as a violation.

    ``warn`` keeps violating rows, ``error`` sends them to quarantine.
    """

    name: str
    condition: str
    level: str = "warn"

    def __post_init__(self) -> None:
        if self.level not in ("warn", "error"):
            raise ValueError(f"Rule level must be 'warn' or 'error', not {self.level!r}")


def mark_failures(df: DataFrame, rules: Sequence[Rule], column: str = FAILED) -> DataFrame:
    """Append the names of the rules each row breaks."""
    broken = [F.when(~F.coalesce(F.expr(rule.condition), F.lit(False)), F.lit(rule.name)) for rule in rules]
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn(column, names)


def _breaks_error(rules: Sequence[Rule], column: str):
    names = [rule.name for rule in rules if rule.level == "error"]
    if not names:
        return F.lit(False)
    return F.arrays_overlap(F.col(column), F.array(*[F.lit(name) for name in names]))


def passing_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break no error rule."""
    return mark_failures(df, rules).where(~_breaks_error(rules, FAILED)).drop(FAILED)


def quarantined_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break an error rule, with all the rules they break."""
    return mark_failures(df, rules).where(_breaks_error(rules, FAILED))


def split_rows(df: DataFrame, rules: Sequence[Rule], path: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Good rows, quarantined rows and violations per rule from one pass over ``df``.

    The marked rows are written once to ``path``, good and quarantined ones apart, and
    the counts are observed while they are.  Key ``checked`` counts all rows.
    """
    seen = Observation("expectations")
    marked = mark_failures(df, rules)
    counts = [F.count_if(F.array_contains(FAILED, rule.name)).alias(f"r{i}") for i, rule in enumerate(rules)]
    marked.observe(seen, F.count(F.lit(1)).alias("checked"), *counts).withColumn(
        QUARANTINED, _breaks_error(rules, FAILED)).write.partitionBy(QUARANTINED).parquet(path)
    written = df.sparkSession.read.schema(marked.schema.add(QUARANTINED, "boolean")).parquet(path)
    found = {"checked": seen.get["checked"], **{rule.name: seen.get[f"r{i}"] for i, rule in enumerate(rules)}}
    return (written.where(~F.col(QUARANTINED)).drop(FAILED, QUARANTINED),
            written.where(F.col(QUARANTINED)).drop(QUARANTINED), found)


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: ``rule, level, checked, violations``; a single pass."""
    counts = [F.count_if(~F.coalesce(F.expr(rule.condition), F.lit(False))) for rule in rules]
    totals = df.agg(F.count(F.lit(1)).alias("checked"), F.array(*counts).alias("violated"))
    entries = F.array(*[
        F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.level).alias("level"),
                 F.col("checked"), F.get("violated", F.lit(i)).alias("violations"))
        for i, rule in enumerate(rules)
    ])
    return totals.select(F.inline(entries))
