"""Layer hops and sinks, run over the given tables.

Each query writes its layers below the session's shared folder and reads them back.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from ..operators.reshape import latest_per_key
from ..plans import models
from ..plans.build import build_models
from ..plans.quality import apply_contract_types, flag_duplicates_in_batch, normalise_strings, pii_hash
from ..sources import layers as ly
from ..sources.contract import contract_from, get_contract
from ..sources.files import csv_stream_source, processed_file_ledger, table_stream_source
from ..sources.folders import new_folder
from ..sources.partitions import upsert_partitions
from ..streaming import hops
from .registry import query, text
from .reshape import DATAMART_SQL, bronze_customers, bronze_sales, datamart

INGESTED = "2024-01-31"

CONTRACTS = Path(__file__).resolve().parent.parent / "contracts"
ORDERS_CONTRACT = get_contract(CONTRACTS, "orders")


def _raw_orders(t):
    """Orders as raw text, the closed ones dropped twice."""
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("cliente_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("prioridade"),
        F.to_date("o_orderdate").alias("data_venda"),
    )
    return rows.unionByName(rows.where("status = 'F'"))


def _to_bronze(t, root, runs=1):
    _raw_orders(t).write.option("header", True).csv(f"{root}/raw")
    for _ in range(runs):
        # A second run finds no new file and adds nothing.
        hops.raw_to_bronze(t.spark, f"{root}/raw", f"{root}/bronze", f"{root}/checkpoints/bronze", INGESTED)
    return t.spark.read.parquet(f"{root}/bronze")


def _to_silver(t, root, runs=1):
    _to_bronze(t, root)
    for _ in range(runs):
        hops.bronze_to_silver(
            t.spark, f"{root}/bronze", f"{root}/silver", f"{root}/quarantine", f"{root}/checkpoints/silver", ORDERS_CONTRACT
        )


_RAW = """
  (SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS cliente_id, o_orderstatus AS status,
    o_orderpriority AS prioridade, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data_venda FROM orders
  UNION ALL SELECT CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) FROM orders WHERE o_orderstatus = 'F')
"""


@query("raw_to_bronze", f"SELECT *, '{INGESTED}' AS dt_ingest FROM {_RAW}")
def raw_to_bronze(t):
    bronze = _to_bronze(t, new_folder(t.spark, "raw-to-bronze"), runs=2)
    return bronze.select("id", "cliente_id", "status", "prioridade", "data_venda", text("dt_ingest"))


@query(
    "processed_file_ledger",
    f"SELECT '{INGESTED}' AS process_date, 'processed' AS status, count(*) AS n_rows FROM {_RAW}",
)
def ledger(t):
    files = processed_file_ledger(_to_bronze(t, new_folder(t.spark, "ledger")))
    by_day = files.groupBy(text("process_date"), "status")
    return by_day.agg(F.sum("n_rows").alias("n_rows"))


@query(
    "bronze_to_silver",
    f"""
    SELECT o_orderkey AS id, sha256(CAST(o_custkey AS VARCHAR)) AS cliente_id, o_orderstatus AS status, o_orderpriority AS prioridade,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data_venda, '{INGESTED}' AS dt_ingest
    FROM orders WHERE o_orderstatus IN ('O', 'F') AND o_orderpriority <> '5-LOW'
    """,
)
def bronze_to_silver(t):
    """Valid orders; a hashed number is text from then on."""
    root = new_folder(t.spark, "bronze-to-silver")
    _to_silver(t, root)
    silver = ly.current_rows(t.spark, f"{root}/silver", ["id"])
    return silver.select("id", "cliente_id", "status", "prioridade", text("data_venda"), text("dt_ingest"))


@query(
    "quarantine_sink",
    f"""
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY id) AS rn FROM {_RAW})
    SELECT id, sha256(cliente_id) AS cliente_id, status, prioridade, '{INGESTED}' AS dt_ingest, concat_ws(',',
      CASE WHEN status NOT IN ('O', 'F') THEN 'in_set:status' END,
      CASE WHEN NOT regexp_matches(prioridade, '^[1-4]-') THEN 'regex:prioridade' END,
      CASE WHEN rn > 1 THEN 'unique:id' END) AS reasons
    FROM r WHERE status NOT IN ('O', 'F') OR NOT regexp_matches(prioridade, '^[1-4]-') OR rn > 1
    """,
)
def quarantine(t):
    root = new_folder(t.spark, "quarantine")
    _to_silver(t, root, runs=2)
    rows = ly.read_log(t.spark, f"{root}/quarantine", merge_schema=True)
    return rows.select(
        "id", "cliente_id", "status", "prioridade", text("dt_ingest"), F.concat_ws(",", "_reasons").alias("reasons")
    )


@query(
    "silver_to_warehouse",
    f"""
    SELECT status, '{INGESTED}' AS dt_ingest, 'run-0001' AS _run_id, true AS loaded, count(*) AS n_rows FROM orders
    WHERE o_orderstatus IN ('O', 'F') AND o_orderpriority <> '5-LOW' GROUP BY o_orderstatus
    """.replace("SELECT status", "SELECT o_orderstatus AS status"),
)
def silver_to_warehouse(t):
    root = new_folder(t.spark, "warehouse")
    _to_silver(t, root)
    for _ in range(2):
        hops.silver_to_warehouse(
            t.spark, f"{root}/silver", f"{root}/checkpoints/load", hops.file_sink(f"{root}/warehouse"), "run-0001"
        )
    loaded = t.spark.read.parquet(f"{root}/warehouse")
    return loaded.groupBy(
        "status", text("dt_ingest"), "_run_id", F.col("_loaded_at").isNotNull().alias("loaded")
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "keyed_upsert_batch",
    "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1",
)
def keyed_upsert(t):
    """A stream of events upserted per user: each batch logs its latest row per key."""
    root = new_folder(t.spark, "upsert")
    t.events.repartitionByRange(4, "event_id").write.parquet(f"{root}/in")

    def process(batch, batch_id):
        latest = batch.groupBy("user_id").agg(
            F.max_by(F.struct("event_id", "event_type", "value"), "event_id").alias("r")
        )
        # A batch that runs twice replaces its own folder.
        for _ in range(2):
            ly.write_batch(latest.select("user_id", "r.*"), f"{root}/log", batch_id)

    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query_ = (
        stream.writeStream.foreachBatch(process)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    # Files arrive in any order, so the latest event decides, not the latest batch.
    log = ly.read_log(t.spark, f"{root}/log")
    return latest_per_key(log, ["user_id"], "event_id").select("user_id", "event_id", "event_type", "value")


@query(
    "compacted_log",
    "SELECT o_custkey, max(o_orderkey) AS last_order FROM orders GROUP BY 1",
)
def compacted_log(t):
    """Three logged batches, compacted after the second, read from the snapshot on."""
    root = new_folder(t.spark, "compact")
    for number, status in enumerate(["O", "F", "P"]):
        upto = t.orders.where(F.col("o_orderstatus").isin(["O", "F", "P"][: number + 1]))
        batch = upto.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last_order"))
        ly.write_batch(batch, f"{root}/log", number)
        if number == 1:
            ly.compact(t.spark, f"{root}/log", ["o_custkey"], f"{root}/snapshot", (0, 1))
    return ly.current_rows(t.spark, f"{root}/log", ["o_custkey"], f"{root}/snapshot", (0, 1))


@query(
    "log_upkeep",
    "SELECT user_id, max(event_id) AS event_id, max_by(event_type, event_id) AS event_type, 4 AS batches_left FROM events GROUP BY 1",
)
def log_upkeep(t):
    """Ten batches, compacted after the fourth and the eighth, old ones deleted: read from the last snapshot on."""
    path = f"{new_folder(t.spark, 'upkeep')}/log"
    for number in range(10):
        batch = t.events.where(F.pmod(F.floor(F.col("event_id") / 7), F.lit(10)) == number)
        latest = batch.groupBy("user_id").agg(F.max_by(F.struct("event_id", "event_type"), "event_id").alias("r"))
        # Batches come in any order of events, so each takes on what the log has of its users.
        if number:
            known = ly.current_rows(t.spark, path, ["user_id"]).select("user_id", F.struct("event_id", "event_type").alias("r"))
            latest = latest.unionByName(known).groupBy("user_id").agg(F.max("r").alias("r"))
        ly.write_batch(latest.select("user_id", "r.*"), path, number)
        if number in (3, 7):
            ly.compact_log(t.spark, path, ["user_id"], (0, number))
    ly.vacuum_log(t.spark, path, keep=2)
    ly.compact_log(t.spark, path, ["user_id"])
    ly.vacuum_log(t.spark, path, keep=2)
    left = len(ly.committed_batches(t.spark, path)) + len(ly.published_snapshots(t.spark, path))
    return ly.current_rows(t.spark, path, ["user_id"]).withColumn("batches_left", F.lit(left))


@query(
    "incremental_upsert_model",
    """
    SELECT o_custkey, max(o_orderkey) AS last_order, 'new' AS source FROM orders WHERE o_orderdate >= DATE '2000-01-01' GROUP BY 1
    UNION ALL
    SELECT o_custkey, max(o_orderkey), 'old' FROM orders WHERE o_orderdate < DATE '2000-01-01'
      AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= DATE '2000-01-01') GROUP BY 1
    """,
)
def incremental_upsert_model(t):
    new = F.col("o_orderdate") >= F.lit("2000-01-01").cast("date")

    def last(rows, label):
        return rows.groupBy("o_custkey").agg(
            F.max("o_orderkey").alias("last_order"), F.lit(label).alias("source")
        )

    return ly.incremental_upsert(last(t.orders.where(~new), "old"), last(t.orders.where(new), "new"), ["o_custkey"])


@query("incremental_silver_build", DATAMART_SQL.replace("'cidade ' || c.c_nationkey", "'cidade nova ' || c.c_nationkey"))
def incremental_silver_build(t):
    """Two runs: the first brings old places and some prices of nought, the second replaces them."""
    root = new_folder(t.spark, "build")
    customers = bronze_customers(t).withColumn("email", F.concat("nome", F.lit("@mail.com")))
    sales = bronze_sales(t)
    odd = F.col("quantidade") % 2 == 1
    build_models(customers, sales.withColumn("valor_total", F.when(odd, 0.0).otherwise(F.col("valor_total"))), root, 1, "year")
    moved = customers.withColumn("cidade", F.regexp_replace("cidade", "cidade", "cidade nova"))
    mart = build_models(moved, sales, root, 2, "year")
    return mart.withColumn("data_venda", text("data_venda"))


@query(
    "partition_upsert_model",
    """
    WITH o AS (SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS d, o_custkey % 50 = 0 AND year(o_orderdate) = 1996 AS changed FROM orders),
    n AS (SELECT o_orderkey, CASE WHEN changed THEN 0.0 ELSE o_totalprice END AS o_totalprice, changed,
      year(d) + CASE WHEN changed AND o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS y FROM o)
    SELECT o_orderkey, o_totalprice, y AS order_year, y IN (SELECT y FROM n WHERE changed UNION SELECT 1996 WHERE (SELECT count(*) FROM n WHERE changed) > 0) AS rewritten
    FROM n
    """,
)
def partition_upsert_model(t):
    """Orders by year, then changes of one year, some into the next: the second run rewrites these two years only."""
    path = f"{new_folder(t.spark, 'partitions')}/orders"
    first = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"), "o_custkey")
    upsert_partitions(first.drop("o_custkey"), path, "o_orderkey", "order_year", 1).publish()
    changed = first.where("o_custkey % 50 = 0 and order_year = 1996").drop("o_custkey")
    moved = F.when(F.col("o_orderkey") % 3 == 0, F.col("order_year") + 1).otherwise(F.col("order_year"))
    second = upsert_partitions(changed.withColumns({"o_totalprice": F.lit(0.0), "order_year": moved}), path, "o_orderkey", "order_year", 2)
    second.publish()
    new = [int(year) for year, folder in second.parts.items() if "/run=2-" in folder]
    return second.rows().withColumn("rewritten", F.col("order_year").isin(new))


@query("clustered_table_model", DATAMART_SQL)
def clustered_table_model(t):
    root = new_folder(t.spark, "clustered")
    ly.clustered_write(datamart(t), root, ["cliente_id", "data_venda"])
    return t.spark.read.parquet(root)


@query(
    "partitioned_append_sink",
    "SELECT c_mktsegment, count(*) AS n_rows FROM customer GROUP BY 1",
)
def partitioned_append(t):
    """A partitioned first load, read back by partition."""
    root = new_folder(t.spark, "append")
    ly.write_batch(t.customer, root, 0, partition_by=["c_mktsegment"])
    return ly.read_log(t.spark, root).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    "load_metadata_columns",
    "SELECT s_suppkey, 'run-0001' AS _run_id, true AS loaded FROM supplier",
)
def load_metadata_columns(t):
    rows = hops.with_load_metadata(t.supplier.select("s_suppkey"), "run-0001")
    return rows.select("s_suppkey", "_run_id", F.col("_loaded_at").isNotNull().alias("loaded"))


@query(
    "hashed_silver_customers",
    "SELECT c_custkey AS cliente_id, sha256(c_name) AS nome, 'cidade ' || c_nationkey AS cidade FROM customer",
)
def hashed_silver_customers(t):
    from .reshape import bronze_customers

    contract = contract_from(
        {"table": "clientes", "fields": [{"name": "id", "type": "integer"}, {"name": "nome", "type": "string", "pii": True}]}
    )
    silver = models.silver_customers(pii_hash(bronze_customers(t), contract))
    return silver.select("cliente_id", "nome", "cidade")


# --- sources, triggers and sinks one by one ----------------------------------


def _drain(stream, root, sink=None):
    """Run a stream until it has read what is there; into files unless a sink is given."""
    writer = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    if sink is None:
        writer = writer.format("parquet").option("path", f"{root}/out")
    else:
        writer = writer.foreachBatch(sink)
    writer.start().awaitTermination()


def _event_files(t, root, files=4):
    """Events as a folder of a few files, and their stream, one file per batch."""
    t.events.repartitionByRange(files, "event_id").write.mode("append").parquet(f"{root}/in")
    return table_stream_source(t.spark, f"{root}/in", max_files_per_batch=1)


_BY_TYPE = "SELECT event_type, count(*) AS n_events, round(sum(value), 2) AS total FROM events GROUP BY 1"


def _by_type(rows):
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("total")
    )


@query(
    "contract_source",
    """
    SELECT o_orderkey AS id, o_custkey AS cliente_id, o_orderstatus AS status, o_orderpriority AS prioridade,
      CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS data_venda FROM orders
    UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
    FROM orders WHERE o_orderstatus = 'F'
    """,
)
def contract_source(t):
    """A table read in the types of its contract file."""
    contract = get_contract(CONTRACTS, "orders")
    typed = apply_contract_types(normalise_strings(_raw_orders(t), contract.names), contract)
    return typed.withColumn("data_venda", text("data_venda"))


@query("csv_stream_source", f"SELECT * FROM {_RAW}")
def csv_source(t):
    root = new_folder(t.spark, "csv-source")
    _raw_orders(t).write.option("header", True).csv(f"{root}/raw")
    _drain(csv_stream_source(t.spark, f"{root}/raw"), root)
    return t.spark.read.parquet(f"{root}/out")


@query(
    "ingest_append_sink",
    """
    SELECT '2024-01-30' AS dt_ingest, status, count(*) AS n_rows FROM (SELECT o_orderstatus AS status FROM orders) GROUP BY 2
    UNION ALL
    SELECT '2024-01-31', o_orderstatus, count(*) FROM orders WHERE o_orderstatus = 'F' GROUP BY 2
    """,
)
def ingest_append(t):
    """Two drops on two days: each run takes the new files only."""
    root = new_folder(t.spark, "ingest")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    for day, drop in (("2024-01-30", rows), ("2024-01-31", rows.where("status = 'F'"))):
        drop.write.mode("append").option("header", True).csv(f"{root}/raw")
        hops.raw_to_bronze(t.spark, f"{root}/raw", f"{root}/bronze", f"{root}/checkpoint", day)
    bronze = t.spark.read.parquet(f"{root}/bronze")
    return bronze.groupBy(text("dt_ingest"), "status").agg(F.count(F.lit(1)).alias("n_rows"))


@query("table_stream_source", _BY_TYPE)
def table_source(t):
    root = new_folder(t.spark, "table-source")
    _drain(_event_files(t, root), root)
    return _by_type(t.spark.read.parquet(f"{root}/out"))


@query("available_now_trigger", _BY_TYPE)
def available_now(t):
    """Four files, one per batch, drained by one run that ends by itself."""
    root = new_folder(t.spark, "available-now")
    _drain(_event_files(t, root), root, hops.file_sink(f"{root}/out", ("event_type",)))
    return _by_type(t.spark.read.parquet(f"{root}/out"))


@query(
    "checkpoint",
    "SELECT event_type, 2 * count(*) AS n_events, round(2 * sum(value), 2) AS total FROM events GROUP BY 1",
)
def checkpoint(t):
    """Two drops of the events, three runs: every file is read once."""
    root = new_folder(t.spark, "checkpointed")
    for _ in range(2):
        _drain(_event_files(t, root, files=2), root)
    _drain(table_stream_source(t.spark, f"{root}/in"), root)
    return _by_type(t.spark.read.parquet(f"{root}/out"))


@query("foreach_batch", _BY_TYPE)
def foreach_batch(t):
    """Every batch runs twice, as after a failure, and counts once."""
    root = new_folder(t.spark, "foreach")

    def process(batch, batch_id):
        for _ in range(2):
            ly.write_batch(batch, f"{root}/log", batch_id, partition_by=["event_type"])

    _drain(_event_files(t, root), root, process)
    return _by_type(ly.read_log(t.spark, f"{root}/log"))


@query("batch_dedup", _BY_TYPE)
def batch_dedup(t):
    """Events dropped twice into one batch; the second copies are flagged in it."""
    root = new_folder(t.spark, "batch-dedup")
    for _ in range(2):
        t.events.write.mode("append").parquet(f"{root}/in")
    stream = table_stream_source(t.spark, f"{root}/in").select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )

    def process(batch, batch_id):
        flagged = flag_duplicates_in_batch(batch, "event_id", ["file", "row"], "repeated")
        ly.write_batch(flagged.where("not repeated"), f"{root}/log", batch_id)

    _drain(stream, root, process)
    return _by_type(ly.read_log(t.spark, f"{root}/log"))


@query(
    "warehouse_append_sink",
    "SELECT event_type, count(*) AS n_events, round(sum(value), 2) AS total, 4 AS n_loads FROM events GROUP BY 1",
)
def warehouse_append(t):
    """Each batch is appended under its load number."""
    root = new_folder(t.spark, "warehouse-append")
    _event_log(t, f"{root}/in")
    hops.silver_to_warehouse(
        t.spark, f"{root}/in", f"{root}/checkpoint", hops.file_sink(f"{root}/out", ("event_type",)), "run-0001", 1
    )
    loaded = t.spark.read.parquet(f"{root}/out")
    loads = loaded.agg(F.count_distinct("load_batch").cast("int").alias("n_loads"))
    return _by_type(loaded).crossJoin(F.broadcast(loads))


def _event_log(t, path):
    """All events as a log of four batches."""
    for number in range(4):
        ly.write_batch(t.events.where(F.col("event_id") % 4 == number), path, number)


@query("warehouse_replaced_batch", _BY_TYPE)
def warehouse_replaced_batch(t):
    """A batch is loaded, written again with rows it lacked, and loaded again: each row is there once."""
    root = new_folder(t.spark, "replaced-batch")
    sink = hops.file_sink(f"{root}/warehouse", ())
    late = F.col("event_type") == "purchase"
    ly.write_batch(t.events.where(~late), f"{root}/silver", 0)
    for _ in range(2):
        hops.silver_to_warehouse(t.spark, f"{root}/silver", f"{root}/checkpoint", sink, "run-0001")
        ly.write_batch(t.events, f"{root}/silver", 0)
    hops.silver_to_warehouse(t.spark, f"{root}/silver", f"{root}/checkpoint", sink, "run-0002")
    return _by_type(t.spark.read.parquet(f"{root}/warehouse"))


@query(
    "log_with_null_keys",
    """
    WITH o AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS k FROM orders),
    kept AS (SELECT k, max(o_orderkey) AS last_order FROM o WHERE k IS NOT NULL GROUP BY 1
      UNION ALL SELECT k, o_orderkey FROM o WHERE k IS NULL)
    SELECT stage, k, last_order FROM kept, (VALUES ('log'), ('snapshot')) AS s(stage)
    """,
)
def log_with_null_keys(t):
    """Orders without a key are no versions of one another, before and after compaction."""
    root = new_folder(t.spark, "null-keys")
    keyed = t.orders.select(F.when(F.col("o_orderstatus") != "F", F.col("o_custkey")).alias("k"), "o_orderkey")
    ly.write_batch(keyed.where("k is null").select("k", F.col("o_orderkey").alias("last_order")), f"{root}/log", 0)
    ly.write_batch(keyed.where("k is not null").groupBy("k").agg(F.max("o_orderkey").alias("last_order")), f"{root}/log", 1)
    ly.compact(t.spark, f"{root}/log", ["k"], f"{root}/snapshot", (0, 1))
    plain = ly.current_rows(t.spark, f"{root}/log", ["k"])
    on_top = ly.current_rows(t.spark, f"{root}/log", ["k"], f"{root}/snapshot", (0, 1))
    stages = [rows.select(F.lit(stage).alias("stage"), "k", "last_order") for stage, rows in (("log", plain), ("snapshot", on_top))]
    return stages[0].unionByName(stages[1])


@query(
    "downstream_stream_of_merged_table",
    "SELECT user_id, max(event_id) AS event_id FROM events GROUP BY 1",
)
def downstream(t):
    """A log of upserts is streamed on, although its keys are updated."""
    root = new_folder(t.spark, "downstream")

    def upsert(batch, batch_id):
        ly.write_batch(batch.groupBy("user_id").agg(F.max("event_id").alias("event_id")), f"{root}/silver", batch_id)

    _drain(_event_files(t, root), root, upsert)
    hops.silver_to_warehouse(
        t.spark, f"{root}/silver", f"{root}/load-checkpoint", hops.file_sink(f"{root}/warehouse", ()), "run-0001"
    )
    loaded = t.spark.read.parquet(f"{root}/warehouse")
    return latest_per_key(loaded, ["user_id"], "event_id").select("user_id", "event_id")


@query(
    "archive_after_ingest",
    "SELECT o_orderstatus AS status, count(*) AS n_rows FROM orders GROUP BY 1",
)
def archive_after_ingest(t):
    """One drop per status; a run archives the files of runs before it and reads its own."""
    root = new_folder(t.spark, "archive")
    rows = t.orders.select("o_orderkey", F.col("o_orderstatus").alias("status"))
    for status in ("O", "F", "P"):
        rows.where(F.col("status") == status).write.mode("append").option("header", True).csv(f"{root}/raw")
        hops.raw_to_bronze(
            t.spark, f"{root}/raw", f"{root}/bronze", f"{root}/checkpoint", INGESTED, archive_dir=f"{root}/archive"
        )
    return t.spark.read.parquet(f"{root}/bronze").groupBy("status").agg(F.count(F.lit(1)).alias("n_rows"))
