"""Many checks over one table in one pass.

Row rules and global aggregates become columns of a single ``agg``, so a table is
read once however many checks there are. Checks that return keys or groups are
counted apart and joined on as rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import holds, truth
from .core import Condition


@dataclass(frozen=True)
class Check:
    """A check and its thresholds.

    ``rule`` marks violating rows; ``metric`` is an aggregate and gives the number
    of failures itself; ``found`` is a list of findings from the schema. The
    thresholds are conditions on the failure count.
    """

    name: str
    rule: Column | None = None
    metric: Column | None = None
    found: Sequence | None = None
    row_condition: Condition | None = None
    severity: str = "error"
    warn_if: str = "<> 0"
    error_if: str = "<> 0"

    def failures(self) -> Column:
        if self.found is not None:
            return F.lit(len(self.found))
        if self.metric is not None:
            return self.metric
        rule = self.rule
        if self.row_condition is not None:
            rule = holds(truth(self.row_condition)) & rule
        return F.count_if(rule)

    def status(self, failures: Column) -> Column:
        text = "failures {}".format
        verdict = F.when(F.expr(text(self.warn_if)), "warn").otherwise("pass")
        if self.severity == "error":
            verdict = F.when(F.expr(text(self.error_if)), "error").otherwise(verdict)
        return verdict


def _graded(results: DataFrame, checks: Sequence[Check]) -> DataFrame:
    status = F.lit(None).cast("string")
    for check in checks:
        status = F.when(F.col("check") == check.name, check.status(F.col("failures"))).otherwise(
            status
        )
    return results.withColumn("status", status)


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row per check: name, failures, rows tested, status."""
    names = [c.name for c in checks]
    if len(set(names)) != len(names):
        raise ValueError("check names must be unique")
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[c.failures().cast("bigint").alias(f"_f{i}") for i, c in enumerate(checks)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(n).alias("check"), F.col(f"_f{i}").alias("failures"))
            for i, n in enumerate(names)
        ]
    )
    results = counted.select(F.explode(rows).alias("r"), "_rows").select(
        "r.check", "r.failures", F.col("_rows").alias("rows_tested")
    )
    return _graded(results, checks)


@dataclass(frozen=True)
class Result:
    """Failing rows of a check, to be counted with others."""

    check: Check
    failing: DataFrame
    fail_calc: Column = field(default_factory=lambda: F.count(F.lit(1)))


def test_result(results: Sequence[Result]) -> DataFrame:
    """Count each result's failing rows and grade it."""
    parts = [
        r.failing.agg(F.coalesce(r.fail_calc, F.lit(0)).cast("bigint").alias("failures")).select(
            F.lit(r.check.name).alias("check"), "failures"
        )
        for r in results
    ]
    return _graded(reduce(DataFrame.union, parts), [r.check for r in results])


test_result.__test__ = False
