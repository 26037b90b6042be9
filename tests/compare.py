"""Run registered queries on Spark and their SQL on DuckDB, compare row for row."""

from __future__ import annotations

import math
import re
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    """Value with its type; doubles must agree to the last bit."""
    if isinstance(value, float) and math.isnan(value):
        return "float:nan"
    if isinstance(value, float):
        value += 0.0
    return f"{type(value).__name__}:{value!r}"


def rows_of(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def hazards(df) -> str | None:
    """What in a query's plan would not hold at scale, if anything."""
    text = df._jdf.queryExecution().executedPlan().toString()
    if "CartesianProduct" in text:
        return "multiplies tables"
    if re.search(r"\b(BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups)", text):
        return "leaves the engine"
    # Joins without a key are for one-row aggregates only.
    if any("Inner" not in x and "Cross" not in x for x in re.findall(r"BroadcastNestedLoopJoin.*", text)):
        return "joins without a key"
    return None


def check(spark, con, folder: str, name: str, run, sql: str | None) -> str | None:
    """None if both agree, else what differs."""
    df = run(spark, folder)
    if hazard := hazards(df):
        return hazard
    rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if rows else "no rows"
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    wanted_rows = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    found, wanted = rows_of(df.columns, rows), rows_of(names, wanted_rows)
    if found != wanted:
        extra, missing = found - wanted, wanted - found
        return (
            f"{len(rows)} rows, {len(wanted_rows)} wanted; "
            f"extra {sum(extra.values())}: {list(extra)[:3]}; missing {sum(missing.values())}: {list(missing)[:3]}"
        )
    return None


def main(folder: str, *names: str) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.session import session

    spark, con, sql = session(), database(folder), oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            difference = check(spark, con, folder, name, run, sql.get(name))
        except Exception as error:  # noqa: BLE001
            difference = f"{type(error).__name__}: {str(error)[:600]}"
        bad += difference is not None
        seconds = time.time() - start
        if difference or seconds > 5:
            print(f"{name}: {seconds:.1f}s {difference or 'ok'}", flush=True)
    print(f"{len(queries())} queries, {len(sql)} with SQL, {bad} bad", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]) > 0)
