"""The hops, the upkeep of silver and the models as jobs for ``spark-submit``: ``jobs.py raw-to-bronze --datalake ... --table ...``.

A lake holds ``{layer}/{table}`` folders and a checkpoint per hop and table.
"""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.build import build_models, vacuum_models
from tidemark.sources import layers
from tidemark.sources.contract import get_contract
from tidemark.streaming import hops

log = logging.getLogger("tidemark.jobs")


@dataclass(frozen=True)
class Lake:
    root: str
    table: str

    def layer(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}/{self.table}"

    def checkpoint(self, hop: str) -> str:
        return self.layer(f"checkpoints/{hop}")


def parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--datalake", required=True, help="root of the lake, a URI all executors reach")
    shared.add_argument("--table", required=True, help="of build-models: the folder of the models")
    shared.add_argument("--max_files_per_batch", type=int)

    jobs = argparse.ArgumentParser(description=__doc__)
    commands = jobs.add_subparsers(dest="job", required=True)
    raw = commands.add_parser("raw-to-bronze", parents=[shared])
    raw.add_argument("--execution_date", required=True, help="YYYY-MM-DD")
    raw.add_argument("--archive", action="store_true", help="move files of earlier runs to the archive")
    silver = commands.add_parser("bronze-to-silver", parents=[shared])
    silver.add_argument("--contracts", required=True, help="folder of contract files")
    silver.add_argument("--generation", type=int, default=0, help="counts up when a checkpoint is dropped")
    load = commands.add_parser("silver-to-warehouse", parents=[shared])
    load.add_argument("--run_id")
    upkeep = commands.add_parser("compact-silver", parents=[shared])
    upkeep.add_argument("--contracts", required=True, help="folder of contract files")
    upkeep.add_argument("--keep", type=int, default=2, help="snapshots to keep; batches that older ones hold are deleted")
    models = commands.add_parser("build-models", parents=[shared])
    models.add_argument("--customers", default="clientes", help="silver table of the customers")
    models.add_argument("--sales", default="vendas", help="silver table of the sales")
    models.add_argument("--run", type=int, required=True, help="counts up; a repeated run replaces itself")
    models.add_argument("--granularity", default="day", help="period by which the models are partitioned")
    models.add_argument("--keep", type=int, default=2, help="runs whose partitions are kept")
    return jobs


def new_rows(spark: SparkSession, path: str, checkpoint: str, run: int) -> DataFrame | None:
    """Rows of the silver batches that no earlier run has built, None without any batch.

    The last batch that a run has taken is kept beside the models, committed under the run's number.
    """
    batches = layers.committed_batches(spark, path)
    if not batches:
        return None
    marks = f"{checkpoint}/taken"
    earlier = [n for _, n in layers.committed_batches(spark, marks) if n < run]
    after = None
    if earlier:
        after = tuple(spark.read.json(layers.batch_path(marks, max(earlier))).select(*layers.POSITION).first())
    taken = spark.createDataFrame([batches[-1]], "generation int, batch_id long").coalesce(1)
    taken.write.mode("overwrite").json(layers.batch_path(marks, run))
    return layers.log_rows(spark, path, after)


def build(spark: SparkSession, lake: Lake, arguments: argparse.Namespace) -> bool:
    """Upsert what is new in the silver tables into the models; their tests decide whether it is published."""
    root, found = lake.layer("models"), []
    for name in (arguments.customers, arguments.sales):
        silver = Lake(lake.root, name).layer("silver")
        found.append((f"{lake.checkpoint('build-models')}/{name}", new_rows(spark, silver, f"{lake.checkpoint('build-models')}/{name}", arguments.run)))
    if any(rows is None for _, rows in found):
        return False
    build_models(found[0][1], found[1][1], root, arguments.run, arguments.granularity)
    for checkpoint, _ in found:
        layers.commit_batch(spark, f"{checkpoint}/taken", arguments.run)
    vacuum_models(spark, root, arguments.keep)
    return True


def run(spark: SparkSession, arguments: argparse.Namespace) -> bool:
    """Run one job; False if there was nothing to read yet, which is no failure."""
    lake, limit = Lake(arguments.datalake, arguments.table), arguments.max_files_per_batch
    checkpoint = lake.checkpoint(arguments.job)
    if arguments.job == "raw-to-bronze":
        archive = lake.layer("archive") if arguments.archive else None
        return hops.raw_to_bronze(
            spark, lake.layer("raw"), lake.layer("bronze"), checkpoint, arguments.execution_date, archive, limit
        )
    if arguments.job == "bronze-to-silver":
        contract = get_contract(arguments.contracts, arguments.table)
        return hops.bronze_to_silver(
            spark, lake.layer("bronze"), lake.layer("silver"), lake.layer("quarantine"),
            checkpoint, contract, arguments.generation, limit,
        )
    if arguments.job == "compact-silver":
        contract = get_contract(arguments.contracts, arguments.table)
        at = layers.compact_log(spark, lake.layer("silver"), [contract.primary_key])
        layers.vacuum_log(spark, lake.layer("silver"), arguments.keep)
        return at is not None
    if arguments.job == "build-models":
        return build(spark, lake, arguments)
    sink = hops.file_sink(lake.layer("warehouse"))
    return hops.silver_to_warehouse(spark, lake.layer("silver"), checkpoint, sink, arguments.run_id, limit)


def main(argv: Sequence[str] | None = None) -> None:
    arguments = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"{arguments.job}-{arguments.table}").getOrCreate()
    try:
        if not run(spark, arguments):
            log.warning("%s: nothing to read for %s yet", arguments.job, arguments.table)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
