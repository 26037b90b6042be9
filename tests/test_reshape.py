"""Reshaping and generic table tests on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import rules
from tidemark.operators import reshape as r
from tidemark.operators import table_tests as g
from tidemark.operators.core import only
from tidemark.operators.suite import Check, Result, run_checks, test_result


def tuples(df, *order):
    return sorted((tuple(x) for x in df.collect()), key=repr)


def test_pivot(spark):
    rows = [("north", "tea"), ("north", "rice"), ("north", "tea"), ("south", "rice"), ("south", "rice"), ("south", "rice")]
    df = spark.createDataFrame(rows, "port string, cargo string")
    wide = df.groupBy("port").agg(*r.pivot("cargo", ["rice", "tea"]))
    assert tuples(wide) == [("north", 1, 2), ("south", 3, 0)]
    distinct = df.groupBy("port").agg(*r.pivot("cargo", ["tea"], agg="count", then_value="cargo", else_value=None, distinct=True, suffix="_n"))
    assert distinct.columns == ["port", "tea_n"] and tuples(distinct) == [("north", 1), ("south", 0)]


def test_values_of_a_column(spark):
    df = spark.createDataFrame([("tea", 1), ("rice", 5), ("rice", 2), ("salt", 9)], "cargo string, tons int")
    assert [x[0] for x in r.get_column_values(df, "cargo").collect()] == ["rice", "salt", "tea"]
    assert r.listed_values(df, "cargo", 1) == ["rice"]
    assert r.listed_values(df, "cargo", 9, where="tons < 5") == ["rice", "tea"]
    assert r.listed_values(df, "cargo", 2, order_by=F.min("tons"), descending=False) == ["tea", "rice"]
    assert r.listed_values(None, "cargo", 2, default=["x"]) == ["x"]
    assert r.get_column_values(spark.range(30_000), "id").count() == 30_000


def test_unpivot_keeps_nulls_and_drops_removed_columns(spark):
    df = spark.createDataFrame([(1, "x", True, None)], "id int, name string, ok boolean, n int")
    long = r.unpivot(df, "string", ["ID"], ["name"], "prop", "val")
    assert tuples(long) == [(1, "n", None), (1, "ok", "true")]


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "x", "tea")], "id int, name string, cargo string")
    b = spark.createDataFrame([(2, "y", 7)], "ID bigint, name string, tons int")
    u = r.union_relations({"a": a, "b": b})
    assert u.columns == ["_source_relation", "id", "name", "cargo", "tons"]
    assert tuples(u) == [("a", 1, "x", "tea", None), ("b", 2, "y", None, 7)]
    assert dict(u.dtypes)["id"] == "int"
    over = r.union_relations({"a": a, "b": b}, include=["id"], column_override={"ID": "string"}, source_column_name=None)
    assert over.dtypes == [("id", "string")]
    assert r.union_relations({"a": a, "b": b}, exclude=["name"], where="id = 2").count() == 1
    with pytest.raises(ValueError):
        r.union_relations({"a": a}, include=["id"], exclude=["name"])


def test_a_union_refuses_lossy_numbers(spark):
    def union(first, later, **given):
        frames = {"a": spark.range(1).select(F.lit(1).cast(first).alias("x")), "b": spark.range(1).select(F.lit("2.7").cast("double").cast(later).alias("X"))}
        return r.union_relations(frames, source_column_name=None, **given)

    for first, later in (("int", "double"), ("bigint", "decimal(4,1)"), ("decimal(4,1)", "decimal(6,2)"), ("decimal(9,2)", "double"), ("float", "double"), ("double", "bigint")):
        with pytest.raises(ValueError, match="without loss"):
            union(first, later)
    assert tuples(union("int", "double", column_override={"X": "double"})) == [(1.0,), (2.7,)]
    assert tuples(union("double", "int")) == [(1.0,), (2.0,)] and tuples(union("int", "bigint")) == [(1,), (2,)]


def test_relations_by_name(spark):
    for name in ("zeta_one", "zeta_two", "zeta_skip"):
        spark.range(1).createOrReplaceTempView(name)
    assert list(r.get_relations_by_pattern(spark, "%", "ZETA%", "%skip")) == ["zeta_one", "zeta_two"]
    assert list(r.get_relations_by_prefix(spark, "%", "zeta_t")) == ["zeta_two"]


def test_deduplicate_keeps_rows_with_nulls(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (2, 1, None)], "user_id int, version int, x string")
    assert tuples(r.deduplicate(df, ["user_id"], [F.desc("version")])) == [(1, 2, "b"), (2, 1, None)]


def test_differences_count_nulls_as_equal(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "y"), (3, "y")], "k int, v string")
    assert tuples(r.except_both_ways(a, b)) == [("a_minus_b", 2, "x"), ("b_minus_a", 3, "y")]
    diff = g.equality(a, b)
    assert g.equality_failures(diff).first()[0] == 2
    assert g.equality(a, a).count() == 0 and g.equality_failures(g.equality(a, a)).first()[0] == 0
    assert g.equality(a, b.withColumn("z", F.lit(1)), ["k"]).count() == 2
    assert g.equality_failures(g.equality(a, b.where("k = 1"))).first()[0] == 2


def test_spines(spark):
    days = r.date_spine(spark, "day", "2018-01-01", "2018-01-10")
    assert days.columns == ["date_day"] and days.count() == 9
    assert r.date_spine(spark, "month", "2020-01-15", "2020-04-15").count() == 3
    assert r.date_spine(spark, "hour", "2020-01-01", "2020-01-02").count() == 24
    assert r.date_spine(spark, "day", "2020-01-02", "2020-01-01").count() == 0
    assert r.generate_series(spark, 10).agg(F.sum("generated_number")).first()[0] == 55
    with pytest.raises(ValueError):
        r.generate_series(spark, 0)
    recent = r.get_base_dates(spark, n_dateparts=3, as_of="2024-03-01")
    assert [x[0].date() for x in recent.orderBy("date_day").collect()] == [dt.date(2024, 2, 27) + dt.timedelta(i) for i in range(4)]
    with pytest.raises(ValueError):
        r.get_base_dates(spark)
    facts = spark.createDataFrame([("2024-01-01 05:00:00",), ("2024-01-03 06:00:00",)], "t string").select(F.col("t").cast("timestamp"))
    assert r.date_spine_of(facts, "t").count() == 3
    assert r.date_spine_of(facts, "t", include_last=False).count() == 2
    assert r.date_spine_of(facts.where("false"), "t").count() == 0


def test_columns(spark):
    df = spark.createDataFrame([(1, "", "x")], "Id int, a string, b string")
    assert r.get_filtered_columns_in_relation(df, ["ID"]) == ["a", "b"]
    assert df.select(*r.star(df, ["a"], "p_", "_s")).columns == ["p_Id_s", "p_b_s"]
    assert df.alias("x").select(*r.star(df, ["id"], relation_alias="x")).columns == ["a", "b"]
    assert tuples(r.nullcheck_table(df)) == [(1, None, "x")]
    assert tuples(r.rename_project(df, {"Id": "key"})) == [(1,)]
    kept = only(r.nullcheck_table(df), rules.row_is_counted(["a", "b"], "any_value_is_missing"))
    assert kept.count() == 0


# --- table tests -------------------------------------------------------------


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, "a", 10, "x"), (2, "a", None, "  "), (2, "b", 30, None), (None, "b", 30, "")]
    return spark.createDataFrame(data, "id int, grp string, n int, t string").cache()


def n(df):
    return df.count()


def test_single_table_tests(rows):
    assert n(g.unique(rows, "id")) == 1 and n(g.unique(rows.where("grp = 'a'"), "id")) == 0
    assert n(g.not_null(rows, "id")) == 1 and n(g.not_null(rows, "grp")) == 0
    assert n(g.accepted_values(rows, "grp", ["a", "b"])) == 0
    assert tuples(g.accepted_values(rows, "grp", ["A", "b"])) == [("a", 2)]
    assert n(g.accepted_values(rows, "n", [10, 30])) == 0
    assert n(g.not_accepted_values(rows, "grp", ["c"])) == 0
    assert tuples(g.not_accepted_values(rows, "grp", ["b", "c"])) == [("b",)]
    assert n(g.accepted_range(rows, "n", 10, 30)) == 0
    assert n(g.accepted_range(rows, "n", 10, inclusive=False)) == 1
    assert n(g.row_expression_is_true(rows, "n >= 10")) == 0
    assert n(g.row_expression_is_true(rows, "> 10", "n")) == 1
    assert n(g.at_least_one(rows, "n")) == 0 and n(g.at_least_one(rows.where("id = 2 and grp = 'a'"), "n")) == 1
    assert n(g.at_least_one(rows.where("n is null or grp = 'b'"), "n", ["grp"])) == 1
    assert n(g.not_constant(rows, "n")) == 0 and n(g.not_constant(rows, "n", ["grp"])) == 2
    assert n(g.not_constant(rows.where("n is null"), "n")) == 0
    assert n(g.not_empty_string(rows, "t")) == 2 and n(g.not_empty_string(rows, "t", trim_whitespace=False)) == 1
    assert n(g.not_null_proportion(rows, "n", 0.75)) == 0 and n(g.not_null_proportion(rows, "n", 0.8)) == 1
    assert n(g.not_null_proportion(rows, "n", 0, 0.7)) == 1 and n(g.not_null_proportion(rows, "n", 0.6, group_by=["grp"])) == 1
    assert n(g.unique_combination_of_columns(rows, ["id", "grp"])) == 0
    assert n(g.unique_combination_of_columns(rows, ["grp", "n"])) == 1


def test_two_table_tests(rows, spark):
    parent = spark.createDataFrame([(1,), (None,)], "p int")
    assert tuples(g.relationships(rows, "id", parent, "p")) == [(2, 2)]
    assert n(g.relationships_where(rows, "id", parent, "p", "id <> 2")) == 0
    assert n(g.relationships_where(rows, "id", parent, "p", "id <> 2", "p <> 1")) == 1
    assert n(g.cardinality_equality(rows, "id", rows, "id")) == 0
    assert n(g.cardinality_equality(rows, "id", rows, "n")) == 4
    fewer = rows.where("grp = 'a'")
    assert n(g.equal_rowcount(rows, rows)) == 0 and g.equal_rowcount(rows, fewer).first()["diff_count"] == 2
    # A group of one side only has no difference to count.
    assert n(g.equal_rowcount(rows, fewer, ["grp"])) == 0
    assert n(g.fewer_rows_than(fewer, rows)) == 0
    assert g.fewer_rows_than(rows, rows).first()["row_count_delta"] == 1
    assert g.fewer_rows_than(rows, fewer).first()["row_count_delta"] == 2


def test_suite_grades_by_thresholds(rows):
    checks = [
        Check("id", rules.is_missing("id")),
        Check("id_warns", rules.is_missing("id"), severity="warn"),
        Check("id_tolerated", rules.is_missing("id"), warn_if="> 5", error_if="> 9"),
        Check("expected_failure", rules.is_missing("grp"), error_if="= 0", warn_if="= 0"),
        Check("only_b", rules.is_missing("id"), row_condition="grp = 'a'"),
        Check("null_condition", rules.is_missing("id"), row_condition="n > 10"),
        Check("sum", metric=F.abs(F.sum("n") - 71)),
        Check("schema", found=["x", "y"]),
    ]
    got = {x["check"]: (x["failures"], x["status"], x["rows_tested"]) for x in run_checks(rows, checks).collect()}
    assert got == {
        "id": (1, "error", 4), "id_warns": (1, "warn", 4), "id_tolerated": (1, "pass", 4),
        "expected_failure": (0, "error", 4), "only_b": (0, "pass", 4), "null_condition": (1, "error", 4),
        "sum": (1, "error", 4), "schema": (2, "error", 4),
    }
    with pytest.raises(ValueError):
        run_checks(rows, [checks[0], checks[0]])
    keyed = test_result([
        Result(Check("u"), g.unique(rows, "id")),
        Result(Check("diff"), g.equal_rowcount(rows, rows), F.sum("diff_count")),
    ])
    assert tuples(keyed) == [("diff", 0, "pass"), ("u", 1, "error")]
