"""Published snapshots, deleted batches and partition upserts, told by the files that are read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import jobs
from tidemark.plans.build import ModelTestsFailed
from tidemark.sources import layers as ly
from tidemark.sources.folders import new_folder
from tidemark.sources.partitions import manifest, partition_rows, upsert_partitions, vacuum_partitions
from tidemark.streaming import hops


@pytest.fixture()
def path(spark):
    return f"{new_folder(spark, 'upkeep-test')}/log"


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k int, v string")


def rows(df):
    return sorted((r["k"] is not None, r["k"] or 0, r["v"]) for r in df.collect())


def test_ten_batches_are_read_from_the_snapshot_on(spark, path):
    for number in range(10):
        ly.write_batch(batch(spark, (number % 4, f"v{number}"), (None, f"n{number}")), path, number)
        if number == 5:
            want = rows(ly.current_rows(spark, path, ["k"]))
            assert ly.compact_log(spark, path, ["k"]) == (0, 5)
            assert rows(ly.current_rows(spark, path, ["k"])) == want
    now = ly.current_rows(spark, path, ["k"])
    files = now.inputFiles()
    assert {f.split("batch_id=")[1].split("/")[0] for f in files if "batch_id=" in f} == {"6", "7", "8", "9"}
    assert all(".snapshots/0-5-" in f for f in files if "batch_id=" not in f)
    latest = {k: f"v{max(n for n in range(10) if n % 4 == k)}" for k in range(4)}
    assert rows(now) == sorted([(True, k, v) for k, v in latest.items()] + [(False, 0, f"n{n}") for n in range(10)])
    assert ly.compact_log(spark, path, ["k"], upto=(0, 5)) == (0, 5)  # nothing new up to there


def test_old_batches_go_and_results_stay(spark, path):
    assert ly.compact_log(spark, path, ["k"]) is None and ly.vacuum_log(spark, path) is None
    for number in range(6):
        ly.write_batch(batch(spark, (1, f"v{number}"), (number + 10, "x")), path, number % 3, generation=number // 3)
        if number % 2:
            ly.compact_log(spark, path, ["k"])
    want = rows(ly.current_rows(spark, path, ["k"]))
    assert ly.vacuum_log(spark, path, keep=2) == (1, 0)
    assert ly.committed_batches(spark, path) == [(1, 1), (1, 2)]
    assert [at for at, _ in ly.published_snapshots(spark, path)] == [(1, 2), (1, 0)]
    assert ly.read_log(spark, path).select("generation", "batch_id").distinct().count() == 2
    assert rows(ly.current_rows(spark, path, ["k"])) == want and len(want) == 7
    assert ly.vacuum_log(spark, path, keep=2) == (1, 0)  # again: nothing left to do
    ly.write_batch(batch(spark, (1, "last")), path, 3, generation=1)
    assert (True, 1, "last") in rows(ly.current_rows(spark, path, ["k"]))
    with pytest.raises(ValueError):
        ly.vacuum_log(spark, path, keep=0)


def test_an_unpublished_snapshot_is_not_seen(spark, path):
    ly.write_batch(batch(spark, (1, "a")), path, 0)
    batch(spark, (1, "wrong")).write.parquet(f"{path}.snapshots/0-0-failed")
    ly.add_batch(batch(spark, (1, "not committed")), path, 1)
    assert rows(ly.current_rows(spark, path, ["k"])) == [(True, 1, "a")]


def test_a_warehouse_loads_batches_not_snapshots(spark, path):
    day = F.lit("2024-05-01").cast("date")
    sink = hops.file_sink(f"{path}-warehouse")
    for number in range(4):
        ly.write_batch(batch(spark, (number, "a")).withColumn("dt_ingest", day), path, number)
        if number == 1:
            assert hops.silver_to_warehouse(spark, path, f"{path}-checkpoint", sink)
            ly.compact_log(spark, path, ["k"])
            ly.vacuum_log(spark, path, keep=1)
    assert hops.silver_to_warehouse(spark, path, f"{path}-checkpoint", sink)
    loaded = spark.read.parquet(f"{path}-warehouse")
    assert sorted((r["k"], r["load_batch"]) for r in loaded.collect()) == [(n, f"0_{n}") for n in range(4)]


# --- partitions ----------------------------------------------------------------


def sales(spark, *found):
    return spark.createDataFrame(list(found), "id int, day date, v string")


def test_a_second_run_reads_and_writes_the_touched_dates_only(spark, path):
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    first = upsert_partitions(sales(spark, *((10 * d + i, day, "old") for d, day in enumerate(days) for i in range(3)), (None, days[0], "keyless")), path, "id", "day", 1)
    first.publish()
    # One changes in place, one moves from the second day to the fourth, one is new on the fifth.
    changes = sales(spark, (0, days[0], "new"), (11, days[3], "new"), (99, days[4], "new"), (None, days[4], "keyless"))
    second = upsert_partitions(changes, path, "id", "day", 2)
    assert second.touched == [str(days[i]) for i in (0, 1, 3, 4)]
    assert manifest(spark, path) == first.parts  # not published yet
    second.publish()
    assert second.parts[str(days[2])] == first.parts[str(days[2])]
    assert all("/run=2-" in second.parts[day] for day in second.touched)
    want = {(10 * d + i): (day, "old") for d, day in enumerate(days) for i in range(3)}
    want |= {0: (days[0], "new"), 11: (days[3], "new"), 99: (days[4], "new")}
    got = second.rows().collect()
    assert {r["id"]: (r["day"], r["v"]) for r in got if r["id"] is not None} == want
    assert sorted(r["day"] for r in got if r["id"] is None) == [days[0], days[4]] and len(got) == len(want) + 2
    # The rows read for the merge are those of touched dates.
    merge = partition_rows(spark, path, {d: f for d, f in first.parts.items() if d in second.touched}, "day", second.schema)
    assert {f.split("day=")[1].split("/")[0] for f in merge.inputFiles()} == set(second.touched)
    # A partition all of whose rows have moved is gone; a repeated run starts from the run before it.
    for _ in range(2):
        third = upsert_partitions(sales(spark, *((20 + i, days[4], "moved") for i in range(3))), path, "id", "day", 3)
        third.publish()
        assert str(days[2]) not in third.parts and third.rows().count() == len(got)
    assert manifest(spark, path) == third.parts
    assert vacuum_partitions(spark, path, "day", keep=1) > 0
    assert third.rows().count() == len(got) and vacuum_partitions(spark, path, "day", keep=1) == 0
    with pytest.raises(ValueError):
        upsert_partitions(sales(spark), path, "id", "v", 4)


def test_jobs_build_models_from_what_is_new(spark):
    root = new_folder(spark, "build-job")
    customer = "id int, nome string, email string, telefone string, cidade string, estado string, status string, data_cadastro date"
    sale = "id int, cliente_id int, produto_id int, data_venda date, valor_total double, quantidade int, metodo_pagto string"
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    clients = [(i, f"n{i}", f"{i}@b.c", "t", "Rio", "RJ", "Ativo", days[0]) for i in (1, 2)]

    def job(name, *extra):
        return jobs.run(spark, jobs.parser().parse_args([name, "--datalake", root, *extra]))

    build = lambda run: job("build-models", "--table", "mart", "--run", str(run))
    assert not build(1)  # no silver yet
    ly.write_batch(spark.createDataFrame(clients, customer), f"{root}/silver/clientes", 0)
    ly.write_batch(spark.createDataFrame([(1, 1, 5, days[0], 9.0, 1, "Pix"), (2, 2, 5, days[1], 8.0, 1, "Pix")], sale), f"{root}/silver/vendas", 0)
    assert build(1)
    ly.write_batch(spark.createDataFrame([(2, 2, 5, days[2], 7.0, 1, "Pix"), (3, 1, 5, days[2], 6.0, 1, "Pix")], sale), f"{root}/silver/vendas", 1)
    assert build(2) and build(2)  # a repeated run replaces itself
    mart = spark.read.parquet(f"{root}/models/mart/datamart_resumo_vendas_cliente/run=2")
    assert sorted((r["venda_id"], r["cliente_nome"], r["valor_total"]) for r in mart.collect()) == [(1, "n1", 9.0), (2, "n2", 7.0), (3, "n1", 6.0)]
    parts = manifest(spark, f"{root}/models/mart/ft_vendas")
    assert set(parts) == {str(days[0]), str(days[2])} and "/run=1-" in parts[str(days[0])]
    ly.write_batch(spark.createDataFrame([(4, 99, 5, days[2], 6.0, 1, "Pix")], sale), f"{root}/silver/vendas", 2)
    with pytest.raises(ModelTestsFailed):
        build(3)
    assert manifest(spark, f"{root}/models/mart/ft_vendas") == parts
