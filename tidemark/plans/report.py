"""Contract report: schema, null and business rules of a table in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..sources.contract import Contract

# Patterns and value sets of the two sales tables' business rules.
EMAIL = r"^[\w\.-]+@[\w\.-]+\.\w+$"
STATUSES = ("Ativo", "Inativo", "Pendente")
PAYMENTS = ("Pix", "PIX", "Cartao_Credito", "Cartao_Debito", "Boleto")


class ReportFailed(Exception):
    """A report holds at least one error."""


@dataclass(frozen=True)
class BusinessRule:
    name: str
    column: str
    rule: Column
    severity: str = "ERROR"


def business_rules(table: str) -> list[BusinessRule]:
    """Rules of the customer and sales tables; null passes."""
    make = BusinessRule
    by_table = {
        "clientes": lambda: [
            make("business_email_format", "email", rules.violates(F.col("email").rlike(EMAIL))),
            make("business_state_length", "estado", rules.violates(F.length("estado") == 2)),
            make("business_valid_status", "status", rules.not_in_set("status", STATUSES)),
        ],
        "vendas": lambda: [
            make("business_positive_value", "valor_total", rules.outside("valor_total", 0, strictly=True)),
            make("business_min_quantity", "quantidade", rules.outside("quantidade", 1)),
            make("business_valid_payment", "metodo_pagto", rules.not_in_set("metodo_pagto", PAYMENTS)),
        ],
    }
    return by_table.get(table, list)()


def schema_findings(df: DataFrame, contract: Contract) -> list[tuple[str, str, str]]:
    """Missing columns are errors, extra ones warnings: rule, severity, column."""
    missing = [("schema_missing_columns", "ERROR", c) for c in contract.names if c not in df.columns]
    extra = [("schema_extra_columns", "WARNING", c) for c in df.columns if c not in contract.names]
    return missing + extra


def report_table(
    df: DataFrame, contract: Contract, rules_: Sequence[BusinessRule] | None = None
) -> DataFrame:
    """One row per rule: rule, column, severity, failures, rows, conformity.

    A unique field repeated in the data is a warning. All rules share one pass;
    each unique field needs a distinct count, so they are few.
    """
    if rules_ is None:
        rules_ = business_rules(contract.table)
    counted: list[tuple[str, str, str, Column]] = []
    for f in contract.fields:
        if f.name in df.columns and not f.nullable:
            counted.append(("not_null", f.name, "ERROR", F.count_if(rules.is_missing(f.name))))
    for r in rules_:
        if r.column in df.columns:
            counted.append((r.name, r.column, r.severity, F.count_if(r.rule)))
    for name in contract.unique_names:
        if name in df.columns:
            repeats = F.count(name) - F.count_distinct(name)
            counted.append((f"unique_{name}", name, "WARNING", repeats))

    measured = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[c.alias(f"_f{i}") for i, (_, _, _, c) in enumerate(counted)],
    )

    def entry(rule: str, column: str, severity: str, failures: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"),
            F.lit(column).alias("column"),
            F.lit(severity).alias("severity"),
            failures.cast("bigint").alias("failures"),
        )

    rows = [entry(r, c, s, F.lit(1)) for r, s, c in schema_findings(df, contract)]
    rows += [entry(r, c, s, F.col(f"_f{i}")) for i, (r, c, s, _) in enumerate(counted)]
    rows = rows or [entry("no_rules", "", "INFO", F.lit(0))]
    return measured.select(F.explode(F.array(*rows)).alias("r"), "_rows").select(
        "r.*",
        F.col("_rows").alias("rows_tested"),
        conformity_rate(F.col("r.failures"), F.col("_rows")).alias("conformity_rate"),
    )


def conformity_rate(failures: Column, rows: Column) -> Column:
    """Share of conforming rows; an empty table conforms."""
    return F.coalesce(F.lit(1.0) - F.try_divide(failures, rows), F.lit(1.0))


@dataclass(frozen=True)
class Finding:
    rule: str
    column: str
    severity: str
    failures: int


@dataclass(frozen=True)
class Report:
    """Findings of a validated table; a few rows, one per rule that failed."""

    findings: tuple[Finding, ...]

    @property
    def errors(self) -> tuple[Finding, ...]:
        return tuple(f for f in self.findings if f.severity == "ERROR")

    @property
    def is_valid(self) -> bool:
        return not self.errors

    def raise_on_failure(self) -> None:
        if not self.is_valid:
            raise ReportFailed(", ".join(f"{e.rule}({e.column})" for e in self.errors))


def validate_table(df: DataFrame, contracts: Mapping[str, Contract], table: str) -> Report:
    failed = report_table(df, contracts[table]).where("failures > 0")
    return Report(
        tuple(
            Finding(r["rule"], r["column"], r["severity"], r["failures"]) for r in failed.collect()
        )
    )
