"""Build silver and gold: tests of a layer decide whether the next one is built."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, rules
from ..operators import table_tests as tt
from ..operators.suite import Check, Result, run_checks, test_result
from ..sources.layers import clustered_write
from ..sources.partitions import manifest, upsert_partitions, vacuum_partitions
from .models import sales_datamart, silver_customers, silver_sales
from .report import STATUSES


#: Table, key and date of the silver models.
SILVER = {"customers": ("cl_clientes", "cliente_id", "data_cadastro"), "sales": ("ft_vendas", "venda_id", "data_venda")}


class ModelTestsFailed(Exception):
    """A layer holds rows its tests refuse."""


def silver_tests(customers: DataFrame, sales: DataFrame) -> DataFrame:
    """One graded row per test of the silver models; row rules share a pass per table."""
    by_row = [
        run_checks(
            customers,
            [
                Check("customer_id_not_null", rules.is_missing("cliente_id")),
                Check("customer_email_not_null", rules.is_missing("email")),
                Check("customer_status_accepted", rules.not_in_set("status", STATUSES)),
            ],
        ),
        run_checks(
            sales,
            [
                Check("sale_id_not_null", rules.is_missing("venda_id")),
                Check("sale_customer_not_null", rules.is_missing("cliente_id")),
            ],
        ),
    ]
    orphans = tt.relationships(sales, "cliente_id", customers, "cliente_id")
    by_key = test_result(
        [
            Result(Check("customer_id_unique"), tt.unique(customers, "cliente_id")),
            Result(Check("customer_email_unique"), tt.unique(customers, "email")),
            Result(Check("sale_id_unique"), tt.unique(sales, "venda_id")),
            Result(Check("sale_customer_exists"), orphans, F.sum("failing_rows")),
        ]
    )
    return reduce(DataFrame.unionByName, [r.drop("rows_tested") for r in by_row], by_key)


def gold_tests(mart: DataFrame) -> DataFrame:
    by_row = run_checks(
        mart,
        [
            Check("mart_sale_not_null", rules.is_missing("venda_id")),
            Check("mart_customer_not_null", rules.is_missing("cliente_id")),
        ],
    )
    unique = test_result([Result(Check("mart_sale_unique"), tt.unique(mart, "venda_id"))])
    return unique.unionByName(by_row.drop("rows_tested"))


def require(results: DataFrame) -> None:
    """Raise if a test failed; the results are a handful of rows."""
    failed = results.where("status = 'error'").collect()
    if failed:
        raise ModelTestsFailed(", ".join(f"{r['check']}: {r['failures']}" for r in failed))


def build_models(
    customers: DataFrame, sales: DataFrame, root: str, run: int, granularity: str = "day"
) -> DataFrame:
    """Upsert bronze rows into the silver models, test these, then rebuild and test the gold table.

    A run brings its latest row per key to each silver model, which is partitioned by its date, or by
    the ``granularity`` of it where days hold little. Only the partitions are read and written anew
    that hold one of its keys or get one; the others keep their files. The partitions are published
    when the tests of the run have passed, so a failed run changes nothing for readers or later
    runs. ``run`` counts up; a run that is repeated starts from the one before it.
    """
    spark = customers.sparkSession
    updates = []
    for model, (name, key, date) in ((silver_customers(customers), SILVER["customers"]), (silver_sales(sales), SILVER["sales"])):
        column, rows = _partition(model, date, granularity)
        updates.append(upsert_partitions(rows, f"{root}/{name}", key, column, run))
    silver, facts = (u.rows().drop(u.partition) if u.partition.startswith("_") else u.rows() for u in updates)
    require(silver_tests(silver, facts))
    path = f"{root}/datamart_resumo_vendas_cliente/run={run}"
    clustered_write(sales_datamart(facts, silver), path, ["cliente_id", "data_venda"])
    mart = spark.read.parquet(path)
    require(gold_tests(mart))
    for update in updates:
        update.publish()
    return mart


def _partition(model: DataFrame, date: str, granularity: str) -> tuple[str, DataFrame]:
    """The partition column and the model with it: the date itself, or the period it lies in."""
    if granularity == "day" and isinstance(model.schema[date].dataType, T.DateType):
        return date, model
    name = f"_{date}_{granularity}"
    return name, model.withColumn(name, dates.truncate(granularity, date).cast("date"))


def vacuum_models(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete partitions of the silver models that only runs before the ``keep`` latest read; returns how many."""
    gone = 0
    for name, _, date in SILVER.values():
        path = f"{root}/{name}"
        parts = manifest(spark, path)
        # The folders tell by which column a model is partitioned.
        found = {c for f in set(parts.values()) for c in spark.read.option("basePath", f).parquet(f).columns if c == date or c.startswith(f"_{date}_")}
        column = next((c for c in sorted(found) if c != date), date)
        gone += vacuum_partitions(spark, path, column, keep)
    return gone
