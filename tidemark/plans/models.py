"""Silver and gold models of customers and sales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import lookup_join
from ..operators.reshape import latest_per_key, rename_project

CUSTOMER_COLUMNS = {
    "id": "cliente_id",
    "nome": "nome",
    "email": "email",
    "telefone": "telefone",
    "cidade": "cidade",
    "estado": "estado",
    "status": "status",
    "data_cadastro": "data_cadastro",
}
SALES_COLUMNS = {
    "id": "venda_id",
    "cliente_id": "cliente_id",
    "produto_id": "produto_id",
    "data_venda": "data_venda",
    "valor_total": "valor_total",
    "quantidade": "quantidade",
    "metodo_pagto": "metodo_pagto",
}


def silver_customers(bronze: DataFrame) -> DataFrame:
    """Latest row per customer by registration date; ties go to the greatest text."""
    ties = [c for c in CUSTOMER_COLUMNS if c not in ("id", "data_cadastro")]
    return rename_project(latest_per_key(bronze, ["id"], "data_cadastro", ties), CUSTOMER_COLUMNS)


def silver_sales(bronze: DataFrame) -> DataFrame:
    """Latest row per sale by sale date."""
    ties = [c for c in SALES_COLUMNS if c not in ("id", "data_venda")]
    return rename_project(latest_per_key(bronze, ["id"], "data_venda", ties), SALES_COLUMNS)


def sales_datamart(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Sales with their customer. ``customers`` has one row per customer.

    A sale without a customer has null customer columns, ``cliente_id`` among them;
    its own key stays in ``venda_cliente_id``.
    """
    wanted = customers.select(
        "cliente_id",
        F.col("nome").alias("cliente_nome"),
        F.col("cidade").alias("cliente_cidade"),
        F.col("estado").alias("cliente_estado"),
        F.col("cliente_id").alias("_found"),
    )
    joined = lookup_join(sales, wanted, ["cliente_id"])
    return joined.select(
        "venda_id",
        F.col("_found").alias("cliente_id"),
        "cliente_nome",
        "cliente_cidade",
        "cliente_estado",
        "produto_id",
        "data_venda",
        "valor_total",
        "quantidade",
        "metodo_pagto",
        F.col("cliente_id").alias("venda_cliente_id"),
    )
