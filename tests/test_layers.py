"""Contracts, reports and the streaming hops, on fresh folders."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.plans import models, quality
from tidemark.plans.build import ModelTestsFailed, build_models
from tidemark.plans.report import ReportFailed, validate_table
from tidemark.sources import layers as ly
from tidemark.sources.contract import contract_from, get_contract, spark_type
from tidemark.sources.files import csv_stream_source, processed_file_ledger
from tidemark.sources.folders import new_folder, shared_folder
from tidemark.streaming import hops

CLIENTES = {
    "table": "clientes",
    "fields": [
        {"name": "id", "type": "integer", "unique": True},
        {"name": "email", "type": "string", "regex": r"^[\w\.-]+@[\w\.-]+\.\w+$", "pii": True},
        {"name": "cpf", "type": "string", "regex": r"^[0-9]{3}\.?[0-9]{3}\.?[0-9]{3}-?[0-9]{2}$", "pii": True, "unique": True},
        {"name": "data_cadastro", "type": "date"},
        {"name": "status", "type": "string", "in_set": ["Ativo", "Inativo", "Pendente"]},
    ],
}
CONTRACT = contract_from(CLIENTES)

ROWS = [
    ("1", "a@b.com", "123.456.789-01", "2024-01-01", "Ativo"),
    (" 2 ", "c@d.com.br", "12345678902", "2024-01-02", "Inativo"),
    ("x", "a@b.com", "12345678903", "2024-01-02", "Ativo"),
    ("4", "nomail", "12345678904", "not a date", "Ativo"),
    ("5", None, "12345678905", None, "ativo"),
    ("1", "a@b.com", "12345678906", "2024-01-03", "Ativo"),
    ("7", "a@b.com", "12345678902", "2024-01-03", "Ativo"),
    (None, "a@b.com", None, "2024-01-03", None),
]


def raw(spark, rows, first=0):
    data = [(*r, first + i) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "id string, email string, cpf string, data_cadastro string, status string, line int")


# --- contract ----------------------------------------------------------------


def test_contract_types_and_files(tmp_path):
    (tmp_path / "clientes.json").write_text(json.dumps(CLIENTES), encoding="utf-8")
    contract = get_contract(tmp_path, "clientes")
    assert contract == CONTRACT
    assert contract.primary_key == "id" and contract.unique_names == ["id", "cpf"]
    assert spark_type("IntegerType") == spark_type("integer") == spark_type(" LONG ")
    with pytest.raises(ValueError):
        contract_from({"table": "t", "fields": [{"name": "a", "type": "varchar"}]})
    names = [f.name for f in contract.warehouse_schema().fields]
    assert names == [*contract.names, "dt_ingest", "_run_id", "_loaded_at"]
    assert not contract.warehouse_schema()["dt_ingest"].nullable


def test_validation_gives_reasons(spark):
    checked = quality.validate(raw(spark, ROWS), CONTRACT, ["line"])
    reasons = {r["line"]: list(r["_reasons"]) for r in checked.collect()}
    assert reasons == {
        0: [], 1: [], 2: ["type:id"], 3: ["regex:email"], 4: ["in_set:status"],
        5: ["unique:id"], 6: ["unique:cpf"], 7: [],
    }
    valid, invalid = quality.split_valid_invalid(checked)
    assert valid.count() == 3 and invalid.count() == 5
    # Personal fields are hashed on both sides, null stays null.
    assert {len(r["email"]) for r in checked.where("email is not null").collect()} == {64}
    assert checked.where("line = 4").first()["email"] is None
    typed = quality.apply_contract_types(valid, CONTRACT).orderBy("line").collect()
    assert [r["id"] for r in typed] == [1, 2, None]
    assert str(typed[0]["data_cadastro"]) == "2024-01-01"


def test_contract_without_rules_passes_all(spark):
    plain = contract_from({"table": "t", "fields": [{"name": "status", "type": "string"}]})
    valid, invalid = quality.split_valid_invalid(quality.validate(raw(spark, ROWS), plain, ["line"]))
    assert valid.count() == len(ROWS) and invalid.count() == 0


def test_sensitive_fields(spark):
    df = spark.createDataFrame([("Ana Maria", "11987654321", "1985-06-30")], "nome string, telefone string, data_nascimento string")
    df = df.withColumn("data_nascimento", F.col("data_nascimento").cast("date"))
    policies = [quality.SensitiveField(*p) for p in [
        ("nome", "pseudonymize"), ("telefone", "mask_partial"), ("data_nascimento", "generalize_age"), ("cpf", "hash_sha256")]]
    row = quality.sensitive_field_policy(df, policies, "2024-01-01").first()
    assert len(row["nome"]) == 16 and row["telefone"] == "1198***4321" and row["data_nascimento"] == 30
    with pytest.raises(ValueError):
        quality.sensitive_field_policy(df, [quality.SensitiveField("nome", "drop")])


# --- report ------------------------------------------------------------------

REPORT_CONTRACTS = {
    "clientes": contract_from({"table": "clientes", "fields": [
        {"name": "id", "type": "integer", "nullable": False},
        *[{"name": c, "type": "string"} for c in ("nome", "email", "estado", "status")]]}),
    "vendas": contract_from({"table": "vendas", "fields": [
        {"name": "id", "type": "integer", "nullable": False, "unique": True},
        {"name": "cliente_id", "type": "integer", "nullable": False},
        {"name": "valor_total", "type": "double"}, {"name": "quantidade", "type": "integer"},
        {"name": "metodo_pagto", "type": "string"}]}),
}
CLIENTE = "id int, nome string, email string, estado string, status string"
VENDA = "id int, cliente_id int, valor_total double, quantidade int, metodo_pagto string"


@pytest.mark.parametrize(
    "table, schema, row, wanted, valid",
    [
        ("clientes", CLIENTE, (31, "Ines Prado", "ines.prado@porto.pt", "BA", "Pendente"), set(), True),
        ("clientes", CLIENTE, (32, None, "rui@cais.org", "CE", "Inativo"), set(), True),
        ("clientes", "id int, email string", (33, "rui@cais.org"), {"schema_missing_columns"}, False),
        ("clientes", CLIENTE + ", cep int", (34, "Rui", "rui@cais.org", "CE", "Ativo", 60010), {"schema_extra_columns"}, True),
        ("clientes", CLIENTE, (None, "Rui", "rui@cais.org", "CE", "Ativo"), {"not_null"}, False),
        ("clientes", CLIENTE, (35, "Rui", "rui at cais", "CE", "Ativo"), {"business_email_format"}, False),
        ("clientes", CLIENTE, (36, "Rui", "rui@cais.org", "CEA", "Ativo"), {"business_state_length"}, False),
        ("clientes", CLIENTE, (37, "Rui", "rui@cais.org", "CE", "Novo"), {"business_valid_status"}, False),
        ("vendas", VENDA, (71, 31, 18.5, 4, "PIX"), set(), True),
        ("vendas", VENDA, (72, 31, -0.5, 4, "PIX"), {"business_positive_value"}, False),
        ("vendas", VENDA, (73, 32, 18.5, -3, "PIX"), {"business_min_quantity"}, False),
        ("vendas", VENDA, (74, 32, 18.5, 4, "Vale"), {"business_valid_payment"}, False),
    ],
)
def test_report(spark, table, schema, row, wanted, valid):
    report = validate_table(spark.createDataFrame([row], schema), REPORT_CONTRACTS, table)
    assert {f.rule for f in report.findings} == wanted
    assert report.is_valid is valid
    if valid:
        report.raise_on_failure()
    else:
        with pytest.raises(ReportFailed):
            report.raise_on_failure()


def test_report_warns_of_repeated_ids(spark):
    rows = [(1, 10, 1.0, 1, "Pix"), (1, 11, 1.0, 1, "Pix")]
    report = validate_table(spark.createDataFrame(rows, VENDA), REPORT_CONTRACTS, "vendas")
    assert [(f.rule, f.severity, f.failures) for f in report.findings] == [("unique_id", "WARNING", 1)]
    assert report.is_valid


# --- shared folder -----------------------------------------------------------


def test_layers_go_to_the_named_folder(spark):
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

    class Cluster:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "spark://head:7077", "applicationId": "a"})

    with pytest.raises(RuntimeError):
        shared_folder(Cluster)
    Cluster.conf["spark.checkpoint.dir"] = "s3://lake/shared/"
    assert shared_folder(Cluster) == "s3://lake/shared"
    assert new_folder(Cluster, "x").startswith("s3://lake/shared/x-")
    assert shared_folder(spark) == shared_folder(spark)


# --- models ------------------------------------------------------------------


def test_datamart_keeps_orphan_keys(spark):
    sales = spark.createDataFrame(
        [(1, 10, 5, "2024-01-01", 9.0, 1, "Pix"), (1, 10, 5, "2024-02-01", 8.0, 1, "Pix"), (2, 99, 5, "2024-01-01", 7.0, 1, "Pix")],
        "id int, cliente_id int, produto_id int, data_venda string, valor_total double, quantidade int, metodo_pagto string",
    )
    customers = spark.createDataFrame(
        [(10, "Ana", "e", "t", "Rio", "RJ", "Ativo", "2024-01-01"), (10, "Bia", "e", "t", "Rio", "RJ", "Ativo", "2024-03-01")],
        "id int, nome string, email string, telefone string, cidade string, estado string, status string, data_cadastro string",
    )
    mart = models.sales_datamart(models.silver_sales(sales), models.silver_customers(customers)).orderBy("venda_id").collect()
    assert [(r["venda_id"], r["cliente_id"], r["cliente_nome"], r["valor_total"], r["venda_cliente_id"]) for r in mart] == [
        (1, 10, "Bia", 8.0, 10), (2, None, None, 7.0, 99)]


def test_tests_of_silver_gate_gold(spark, tmp_path):
    sale = "id int, cliente_id int, produto_id int, data_venda date, valor_total double, quantidade int, metodo_pagto string"
    customer = "id int, nome string, email string, telefone string, cidade string, estado string, status string, data_cadastro date"
    day = dt.date(2024, 1, 1)
    customers = spark.createDataFrame([(10, "Ana", "a@b.c", "t", "Rio", "RJ", "Ativo", day)], customer)
    sales = spark.createDataFrame([(1, 10, 5, day, 9.0, 1, "Pix"), (2, 10, 5, day, 8.0, 1, "Pix")], sale)
    mart = build_models(customers, sales, str(tmp_path), 1)
    assert mart.count() == 2 and mart.where("cliente_nome = 'Ana'").count() == 2
    orphans = sales.withColumn("cliente_id", F.lit(99))
    with pytest.raises(ModelTestsFailed, match="sale_customer_exists: 2"):
        build_models(customers, orphans, str(tmp_path), 2)
    assert not (tmp_path / "datamart_resumo_vendas_cliente" / "run=2").exists()
    with pytest.raises(ModelTestsFailed, match="customer_status_accepted"):
        build_models(customers.withColumn("status", F.lit("ativo")), sales, str(tmp_path), 3)
    # The failed runs left nothing behind: a changed and a new sale meet the first run's rows.
    more = spark.createDataFrame([(2, 10, 6, dt.date(2024, 2, 1), 5.0, 1, "Pix"), (3, 10, 5, day, 4.0, 1, "Pix")], sale)
    again = build_models(customers.limit(0), more, str(tmp_path), 4)
    assert sorted((r["venda_id"], r["produto_id"], r["cliente_nome"]) for r in again.collect()) == [(1, 5, "Ana"), (2, 6, "Ana"), (3, 5, "Ana")]
    files = list((tmp_path / "ft_vendas").rglob("data_venda=2024-01-01/*.parquet"))
    assert len(files) <= 4


# --- hops --------------------------------------------------------------------


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)

    def path(self, name):
        return f"{self.root}/{name}"

    def drop(self, rows, name, first=0):
        raw(self.spark, rows, first).drop("line").coalesce(1).write.option("header", True).csv(self.path(f"raw/{name}"))

    def bronze(self, **kw):
        return hops.raw_to_bronze(self.spark, self.path("raw/*"), self.path("bronze"), self.path("cp/bronze"), "2024-05-01", **kw)

    def silver(self, **kw):
        return hops.bronze_to_silver(
            self.spark, self.path("bronze"), self.path("silver"), self.path("quarantine"), self.path("cp/silver"), CONTRACT, **kw)

    def load(self):
        return hops.silver_to_warehouse(
            self.spark, self.path("silver"), self.path("cp/load"), hops.file_sink(self.path("warehouse")), "run1")

    def table(self, name):
        return ly.read_log(self.spark, self.path(name), merge_schema=name == "quarantine")


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, tmp_path)


def test_missing_inputs_are_no_error(spark, lake):
    assert csv_stream_source(spark, lake.path("raw")) is None
    assert hops.raw_to_bronze(spark, lake.path("raw"), lake.path("bronze"), lake.path("cp"), "2024-05-01") is False
    assert lake.silver() is False and lake.load() is False


def test_hops_are_incremental_and_repeatable(lake):
    lake.drop(ROWS, "one")
    for _ in range(2):
        assert lake.bronze() and lake.silver() and lake.load()
    assert lake.table("bronze").count() == len(ROWS)
    assert {t for n, t in lake.table("bronze").dtypes if n in CONTRACT.names} == {"string"}
    assert lake.table("silver").count() == 3 and lake.table("quarantine").count() == 5
    assert lake.table("warehouse").count() == 3
    assert lake.table("warehouse").where("_run_id = 'run1' and _loaded_at is not null").count() == 3
    ledger = processed_file_ledger(lake.table("bronze")).collect()
    assert [(r["status"], r["n_rows"]) for r in ledger] == [("processed", len(ROWS))]

    # A later drop updates key 1 and adds key 8.
    lake.drop([("1", "new@b.com", "12345678901", "2024-02-01", "Inativo"), ("8", "z@b.com", "12345678908", "2024-02-01", "Ativo")], "two")
    assert lake.bronze() and lake.silver() and lake.load()
    now = {r["id"]: r["status"] for r in ly.current_rows(lake.spark, lake.path("silver"), ["id"]).collect()}
    assert now == {1: "Inativo", 2: "Inativo", None: None, 8: "Ativo"}
    log = ly.current_rows(lake.spark, lake.path("silver"), ["id"])
    assert log.where("id is null").count() == 1
    assert lake.table("warehouse").count() == 5


def test_jobs_run_the_hops_over_a_lake(spark, tmp_path):
    lake, contracts = str(tmp_path / "lake"), tmp_path / "contracts"
    contracts.mkdir()
    (contracts / "clientes.json").write_text(json.dumps(CLIENTES), encoding="utf-8")

    def job(*words):
        return jobs.run(spark, jobs.parser().parse_args([*words, "--datalake", lake, "--table", "clientes"]))

    steps = [
        ("raw-to-bronze", "--execution_date", "2024-05-01", "--archive"),
        ("bronze-to-silver", "--contracts", str(contracts)),
        ("silver-to-warehouse", "--run_id", "r1"),
    ]
    assert [job(*s) for s in steps] == [False, False, False]
    raw(spark, ROWS).drop("line").coalesce(1).write.option("header", True).csv(f"{lake}/raw/clientes")
    for _ in range(2):
        assert [job(*s) for s in steps] == [True, True, True]
    counts = [spark.read.parquet(f"{lake}/{layer}/clientes").count() for layer in ("bronze", "silver", "quarantine", "warehouse")]
    assert counts == [8, 3, 5, 3]
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["raw-to-bronze", "--table", "clientes"])


def test_a_repeated_batch_leaves_one_result(spark, lake):
    sink = hops.silver_batch(CONTRACT, lake.path("silver"), lake.path("quarantine"))
    batch = raw(spark, ROWS).select(
        *CONTRACT.names, F.lit("f").alias(hops.FILE), F.col("line").alias(hops.POSITION), F.lit("2024-05-01").cast("date").alias("dt_ingest"))
    for _ in range(3):
        sink(batch, 4)
    sink(batch.where("false"), 5)
    assert lake.table("silver").count() == 3 and lake.table("quarantine").count() == 5
    assert [r[0] for r in lake.table("silver").select("batch_id").distinct().collect()] == [4]


def test_rows_without_a_key_are_all_kept(spark, lake):
    def batch(*rows):
        return spark.createDataFrame(list(rows), "k int, v string")

    path, snap = lake.path("log"), lake.path("snap")
    ly.write_batch(batch((None, "a"), (None, "b"), (1, "c")), path, 0)
    ly.write_batch(batch((None, "a"), (1, "d")), path, 1)
    wanted = ["None a", "None a", "None b", "1 d"]
    rows = lambda df: sorted(f"{r['k']} {r['v']}" for r in df.collect())
    assert rows(ly.current_rows(spark, path, ["k"])) == sorted(wanted)
    ly.compact(spark, path, ["k"], snap, (0, 1))
    assert rows(ly.current_rows(spark, path, ["k"], snap, (0, 1))) == sorted(wanted)


def test_a_hashed_number_stays_text(spark, lake):
    contract = contract_from({"table": "t", "fields": [
        {"name": "id", "type": "integer", "unique": True}, {"name": "cpf", "type": "integer", "pii": True}]})
    assert contract.warehouse_schema()["cpf"].dataType.simpleString() == "string"
    sink = hops.silver_batch(contract, lake.path("silver"), lake.path("quarantine"))
    rows = spark.createDataFrame([("1", "123", "f", 0), ("2", None, "f", 1)], f"id string, cpf string, {hops.FILE} string, {hops.POSITION} int")
    sink(rows.withColumn("dt_ingest", F.lit("2024-05-01").cast("date")), 0)
    got = {r["id"]: r["cpf"] for r in lake.table("silver").collect()}
    assert got[2] is None and len(got[1]) == 64


def test_a_replaced_batch_is_loaded_once(spark, lake):
    def batch(*rows):
        day = F.lit("2024-05-01").cast("date")
        return spark.createDataFrame(list(rows), "k int, v string").withColumn("dt_ingest", day)

    for rows in ([(1, "a"), (2, "b")], [(1, "a"), (2, "b"), (3, "c")]):
        ly.write_batch(batch(*rows), lake.path("silver"), 0)
        assert lake.load() and lake.load()
    ly.write_batch(batch((4, "d")), lake.path("silver"), 1)
    assert lake.load()
    assert sorted(r["k"] for r in lake.table("warehouse").collect()) == [1, 2, 3, 4]


def test_batches_follow_the_file_limit(lake):
    for i in range(3):
        lake.drop([(str(i), "a@b.com", f"1234567890{i}", "2024-01-01", "Ativo")], f"d{i}", i)
    assert lake.bronze(max_files_per_batch=1) and lake.silver(max_files_per_batch=1)
    assert lake.table("silver").select("batch_id").distinct().count() > 1
    assert lake.table("silver").count() == 3


def test_files_are_archived_by_a_later_run(lake):
    archive = Path(lake.path("archive"))
    lake.drop([ROWS[0]], "one")
    assert lake.bronze(archive_dir=str(archive))
    lake.drop([ROWS[1]], "two")
    assert lake.bronze(archive_dir=str(archive))
    lake.drop([ROWS[3]], "three")
    assert lake.bronze(archive_dir=str(archive))
    assert lake.table("bronze").count() == 3
    assert [p for p in archive.rglob("*.csv")]


def test_log_generations_snapshots_and_upsert(spark, lake):
    def batch(*rows):
        return spark.createDataFrame(list(rows), "k int, v string")

    path, snap = lake.path("log"), lake.path("snap")
    ly.write_batch(batch((1, "a"), (2, "b")), path, 0)
    ly.write_batch(batch((1, "c")), path, 1)
    ly.compact(spark, path, ["k"], snap, (0, 1))
    ly.write_batch(batch((2, "d"), (3, "e")), path, 0, generation=1)
    want = {1: "c", 2: "d", 3: "e"}
    plain = {r["k"]: r["v"] for r in ly.current_rows(spark, path, ["k"]).collect()}
    on_top = {r["k"]: r["v"] for r in ly.current_rows(spark, path, ["k"], snap, (0, 1)).collect()}
    assert plain == on_top == want
    ly.compact(spark, path, ["k"], snap, (1, 0), previous=(0, 1))
    again = {r["k"]: r["v"] for r in ly.current_rows(spark, path, ["k"], snap, (1, 0)).collect()}
    assert again == want
    upserted = ly.incremental_upsert(batch((1, "a"), (2, "b")), batch((2, "x"), (3, "y")), ["k"])
    assert {r["k"]: r["v"] for r in upserted.collect()} == {1: "a", 2: "x", 3: "y"}


def test_clustered_files_are_sorted(spark, lake):
    df = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    ly.clustered_write(df, lake.path("mart"), ["k"])
    back = spark.read.parquet(lake.path("mart"))
    assert back.count() == 1000
    spans = back.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("a"), F.max("k").alias("b"))
    ends = sorted((r["a"], r["b"]) for r in spans.collect())
    assert all(x[1] <= y[0] for x, y in zip(ends, ends[1:]))
