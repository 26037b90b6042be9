"""The three hops: raw files to bronze, bronze to silver, silver to the warehouse.

Each drains what is there and stops (``availableNow``), with one checkpoint per hop
and table. Outputs of a micro-batch go to the folder of its batch id, so a batch
that runs twice leaves one result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..plans.quality import (
    apply_contract_types,
    normalise_strings,
    repeated_values,
    split_valid_invalid,
    validate,
)
from ..sources.contract import INGEST_COLUMN, Contract
from ..sources.files import csv_stream_source, table_stream_source
from ..sources.layers import commit_stream, read_batch, write_batch

#: Takes a batch and its number in the source's log, as text.
BatchSink = Callable[[DataFrame, str], None]

FILE, POSITION = "_bronze_file", "_bronze_row"


def _drain(writer: DataStreamWriter, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def raw_to_bronze(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    checkpoint: str,
    execution_date: str,
    archive_dir: str | None = None,
    max_files_per_batch: int | None = None,
) -> bool:
    """Append new CSV files to bronze as text, with ingest date and source file.

    False if there is nothing to read yet; that is not an error.
    """
    stream = csv_stream_source(spark, raw_path, archive_dir, max_files_per_batch)
    if stream is None:
        return False
    bronze = stream.select(
        "*",
        F.col("_metadata.file_path").alias("_source_file"),
        F.lit(execution_date).cast("date").alias(INGEST_COLUMN),
    )
    _drain(
        bronze.writeStream.format("parquet").option("path", bronze_path).outputMode("append"),
        checkpoint,
    )
    return True


def silver_batch(
    contract: Contract, silver_path: str, quarantine_path: str, generation: int = 0
) -> Callable[[DataFrame, int], None]:
    """Validate a micro-batch, quarantine its invalid rows, log its valid ones."""
    extra = [INGEST_COLUMN]

    def process(batch: DataFrame, batch_id: int) -> None:
        # The source is read once: checks and outputs come from what is kept here.
        rows = normalise_strings(batch, contract.names).persist(StorageLevel.MEMORY_AND_DISK)
        order = [FILE, POSITION]
        repeated = None
        if contract.unique_names:
            repeated = repeated_values(rows, contract.unique_names, order).persist(StorageLevel.MEMORY_AND_DISK)
        checked = validate(rows, contract, order, repeated=repeated)
        checked = checked.drop(FILE, POSITION).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            valid, invalid = split_valid_invalid(checked)
            # One pass fills the cache and tells which outputs there are.
            n_reasons = F.size("_reasons")
            found = checked.agg(F.min(n_reasons).alias("least"), F.max(n_reasons).alias("most")).first()
            if found["most"] is None:
                return
            if found["most"] > 0:
                write_batch(invalid, quarantine_path, batch_id, generation, extra)
            if found["least"] == 0:
                typed = apply_contract_types(valid, contract, hashed=True)
                write_batch(typed, silver_path, batch_id, generation, extra)
        finally:
            for kept in (checked, repeated, rows):
                if kept is not None:
                    kept.unpersist()

    return process


def bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    quarantine_path: str,
    checkpoint: str,
    contract: Contract,
    generation: int = 0,
    max_files_per_batch: int | None = None,
) -> bool:
    """Validate new bronze rows into the silver log; False if there is no bronze yet.

    A bronze row is told apart by its file and position, which stay the same when a
    task or a batch is repeated.
    """
    stream = table_stream_source(spark, bronze_path, max_files_per_batch)
    if stream is None:
        return False
    rows = stream.select(
        *contract.names,
        INGEST_COLUMN,
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.row_index").alias(POSITION),
    )
    sink = silver_batch(contract, silver_path, quarantine_path, generation)
    _drain(rows.writeStream.foreachBatch(sink), checkpoint)
    return True


def with_load_metadata(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """Add the load run's id and time."""
    run = run_id or str(uuid.uuid4())[:8]
    return df.withColumns({"_run_id": F.lit(run), "_loaded_at": F.current_timestamp()})


def file_sink(path: str, partition_by: tuple[str, ...] = (INGEST_COLUMN,)) -> BatchSink:
    """Append each batch to a warehouse table on files; loading it again replaces its folder."""

    def write(rows: DataFrame, batch: str) -> None:
        writer = rows.write.mode("overwrite").partitionBy(*partition_by)
        writer.parquet(f"{path}/load_batch={batch}")

    return write


def silver_to_warehouse(
    spark: SparkSession,
    silver_path: str,
    checkpoint: str,
    sink: BatchSink,
    run_id: str | None = None,
    max_files_per_batch: int | None = None,
) -> bool:
    """Load new silver batches through a sink; False if there is no silver yet.

    The stream reads the silver log's commits, one per written batch, and each batch is
    passed on whole under its own number. A batch that is written again is committed
    again, and so loaded again under the same number: a sink that replaces what it has
    of a number holds every row once. ``max_files_per_batch`` bounds the batches a
    micro-batch takes.
    """
    commits = commit_stream(spark, silver_path, max_files_per_batch)
    if commits is None:
        return False

    def process(committed: DataFrame, _: int) -> None:
        named = committed.distinct().orderBy("generation", "batch_id").collect()  # a row per batch
        for generation, batch_id in named:
            rows = read_batch(spark, silver_path, batch_id, generation)
            sink(with_load_metadata(rows, run_id), f"{generation}_{batch_id}")

    _drain(commits.writeStream.foreachBatch(process), checkpoint)
    return True
