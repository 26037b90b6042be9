"""Contract validation: normalise, flag, hash, split into valid and quarantined."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules, scalars
from ..operators.joins import lookup_join
from ..sources.contract import Contract


def normalise_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns as trimmed text; a missing one is an analysis error."""
    return df.withColumns({c: F.trim(F.col(c).cast("string")) for c in columns})


def apply_contract_types(df: DataFrame, contract: Contract, hashed: bool = False) -> DataFrame:
    """Columns in their contract types; text that does not cast becomes null.

    ``hashed`` tells that personal fields are hashes already, which stay text.
    """
    return df.withColumns(
        {f.name: F.col(f.name).try_cast(f.protected_type if hashed else f.spark_type) for f in contract.fields}
    )


def contract_rules(contract: Contract) -> dict[str, Column]:
    """Row rules by name, ``type:id`` for example. Null values pass all of them."""
    found = {}
    for f in contract.fields:
        if f.checks_type:
            found[f"type:{f.name}"] = rules.bad_type(f.name, f.spark_type.simpleString())
        if f.regex:
            found[f"regex:{f.name}"] = rules.violates(F.col(f.name).rlike(f.regex))
        if f.in_set:
            found[f"in_set:{f.name}"] = rules.not_in_set(f.name, f.in_set)
    return found


def _order(row_order: Sequence[str]) -> Column:
    return F.col(row_order[0]) if len(row_order) == 1 else F.struct(*row_order)


def repeated_values(df: DataFrame, fields: Sequence[str], row_order: Sequence[str]) -> DataFrame:
    """``_field, _value, _first``: values that repeat, with their first row, for all fields at once.

    One aggregation, which meets copies before the shuffle. ``row_order`` must tell rows
    apart (file and position, or a key). Null values are exempt.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("_field"), F.col(f).cast("string").alias("_value")) for f in fields]))
    rows = df.select(_order(row_order).alias("_at"), pairs.alias("_p")).where("_p._value is not null")
    counted = rows.groupBy("_p._field", "_p._value").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_copies"))
    return counted.where("_copies > 1").drop("_copies")


def flag_repeated(
    df: DataFrame, repeated: DataFrame, field: str, row_order: Sequence[str], into: str
) -> DataFrame:
    """Mark every row of a repeated value but the first, looked up by value."""
    own = repeated.where(F.col("_field") == field).select(F.col("_value").alias("_key"), "_first")
    keyed = df.withColumn("_key", F.col(field).cast("string"))
    flag = F.coalesce(_order(row_order) != F.col("_first"), F.lit(False))
    return lookup_join(keyed, own, ["_key"]).withColumn(into, flag).select(*df.columns, into)


def flag_duplicates_in_batch(
    df: DataFrame, field: str, row_order: Sequence[str], into: str
) -> DataFrame:
    """Mark every row of a repeated value but the first; null values are exempt."""
    return flag_repeated(df, repeated_values(df, [field], row_order), field, row_order, into)


def validate(
    df: DataFrame,
    contract: Contract,
    row_order: Sequence[str],
    protect: bool = True,
    repeated: DataFrame | None = None,
) -> DataFrame:
    """Rows with their failure reasons in ``_reasons``; personal fields hashed last.

    ``repeated`` are the ``repeated_values`` of the normalised rows, where the caller
    keeps them for several unique fields.
    """
    checked = normalise_strings(df, contract.names)
    flags = dict(contract_rules(contract))
    if contract.unique_names and repeated is None:
        repeated = repeated_values(checked, contract.unique_names, row_order)
    for i, name in enumerate(contract.unique_names):
        checked = flag_repeated(checked, repeated, name, row_order, f"_dup{i}")
        flags[f"unique:{name}"] = F.col(f"_dup{i}")
    reasons = F.array_compact(F.array(*[F.when(flag, F.lit(n)) for n, flag in flags.items()]))
    if not flags:
        reasons = F.array().cast("array<string>")
    checked = checked.withColumn("_reasons", reasons).select(*df.columns, "_reasons")
    return pii_hash(checked, contract) if protect else checked


def pii_hash(df: DataFrame, contract: Contract) -> DataFrame:
    """Replace personal fields by their hash."""
    return df.withColumns({c: scalars.pii_hash(c) for c in contract.pii_names})


def split_valid_invalid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows without, invalid rows with their reasons."""
    clean = F.size("_reasons") == 0
    return checked.where(clean).drop("_reasons"), checked.where(~clean)


# --- sensitive fields --------------------------------------------------------


@dataclass(frozen=True)
class SensitiveField:
    column: str
    action: str


def _protect(policy: SensitiveField, as_of) -> Column:
    actions = {
        "pseudonymize": lambda c: F.left(scalars.pii_hash(c), F.lit(16)),
        "hash_sha256": scalars.pii_hash,
        "mask_partial": scalars.mask_partial,
        "generalize_age": lambda c: scalars.generalize_age(c, as_of),
    }
    if policy.action not in actions:
        raise ValueError(f"unknown action: {policy.action!r}")
    return actions[policy.action](policy.column)


def sensitive_field_policy(
    df: DataFrame, policies: Sequence[SensitiveField], as_of=None
) -> DataFrame:
    """Apply each field's protection; fields the table lacks are skipped."""
    when = F.lit(as_of).cast("date") if as_of is not None else F.current_date()
    present = [p for p in policies if p.column in df.columns]
    return df.withColumns({p.column: _protect(p, when) for p in present})
