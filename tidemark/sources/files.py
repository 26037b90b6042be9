"""File sources: raw CSV drops and layer tables, in batch and as streams."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _schema_or_none(load) -> T.StructType | None:
    """Schema of a source, None where the path is missing or still empty."""
    try:
        schema = load().schema
    except AnalysisException as error:
        if error.getCondition() in MISSING:
            return None
        raise
    return schema if schema.fields else None


def header_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """Text columns named by the files' header."""
    return _schema_or_none(lambda: spark.read.option("header", True).csv(path))


def csv_stream_source(
    spark: SparkSession,
    path: str,
    archive_dir: str | None = None,
    max_files_per_batch: int | None = None,
) -> DataFrame | None:
    """Stream of a raw CSV folder, all text; None if there is nothing to read yet.

    With ``archive_dir`` files are moved away after a later run has seen that their
    batch is committed.
    """
    schema = header_schema(spark, path)
    if schema is None:
        return None
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if archive_dir is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.csv(path)


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    return _schema_or_none(lambda: spark.read.parquet(path))


def table_stream_source(
    spark: SparkSession, path: str, max_files_per_batch: int | None = None
) -> DataFrame | None:
    """Stream of a layer table; None if the table does not exist yet."""
    schema = table_schema(spark, path)
    if schema is None:
        return None
    reader = spark.readStream.schema(schema)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.parquet(path)


def processed_file_ledger(bronze: DataFrame) -> DataFrame:
    """One row per source file taken in, from the file name kept with each row."""
    return bronze.groupBy(F.col("_source_file").alias("file_key")).agg(
        F.min("dt_ingest").alias("process_date"),
        F.lit("processed").alias("status"),
        F.count(F.lit(1)).alias("n_rows"),
    )
