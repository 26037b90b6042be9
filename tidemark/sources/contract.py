"""Data contracts: fields, types and rules of a table, read from JSON."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import types as T

INGEST_COLUMN = "dt_ingest"

# Contract type names and their Spark types.
SPARK_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}


def spark_type(name: str) -> T.DataType:
    """Spark type of a contract type name; ``integer`` and ``IntegerType`` mean the same."""
    key = name.strip().lower().removesuffix("type")
    if key not in SPARK_TYPES:
        raise ValueError(f"unknown contract type: {name!r}")
    return SPARK_TYPES[key]


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    unique: bool = False
    regex: str | None = None
    in_set: tuple[str, ...] | None = None
    pii: bool = False
    nullable: bool = True

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.type)

    @property
    def protected_type(self) -> T.DataType:
        """The type once personal fields are hashed: a hash is text."""
        return T.StringType() if self.pii else self.spark_type

    @property
    def checks_type(self) -> bool:
        """Text, dates and times are not checked for their type."""
        return not isinstance(self.spark_type, (T.StringType, T.DateType, T.TimestampType))


@dataclass(frozen=True)
class Contract:
    table: str
    fields: tuple[Field, ...]
    description: str | None = None

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def unique_names(self) -> list[str]:
        return [f.name for f in self.fields if f.unique]

    @property
    def primary_key(self) -> str | None:
        """The first unique field; other unique fields are checks only."""
        return next(iter(self.unique_names), None)

    @property
    def pii_names(self) -> list[str]:
        return [f.name for f in self.fields if f.pii]

    def raw_schema(self) -> T.StructType:
        """Raw files hold text only."""
        return T.StructType([T.StructField(n, T.StringType()) for n in self.names])

    def warehouse_schema(self) -> T.StructType:
        """Contract fields, the ingest date and the load metadata."""
        fields = [
            T.StructField(f.name, f.protected_type) for f in self.fields if f.name != INGEST_COLUMN
        ]
        return T.StructType(
            [
                *fields,
                T.StructField(INGEST_COLUMN, T.DateType(), nullable=False),
                T.StructField("_run_id", T.StringType()),
                T.StructField("_loaded_at", T.TimestampType()),
            ]
        )


def contract_from(spec: Mapping) -> Contract:
    fields = []
    for item in spec["fields"]:
        values = item.get("in_set")
        fields.append(
            Field(
                name=item["name"],
                type=item["type"],
                unique=bool(item.get("unique", False)),
                regex=item.get("regex"),
                in_set=tuple(values) if values is not None else None,
                pii=bool(item.get("pii", False)),
                nullable=bool(item.get("nullable", True)),
            )
        )
        spark_type(item["type"])
    return Contract(spec["table"], tuple(fields), spec.get("description"))


def get_contract(directory: str | Path, table: str) -> Contract:
    """Contract of a table from ``{directory}/{table}.json``."""
    text = (Path(directory) / f"{table}.json").read_text(encoding="utf-8")
    return contract_from(json.loads(text))
