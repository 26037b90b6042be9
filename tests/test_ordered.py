"""Ranged neighbours, quantiles and joins against brute force, hot groups included."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import expect_values as ev
from tidemark.operators import joins as j
from tidemark.operators import table_tests as tt
from tidemark.operators.ordered import exact_quantile, ranged, with_codes, with_neighbour
from tidemark.plans.quality import flag_duplicates_in_batch


def hot_rows(n=600, seed=3):
    """A third of the rows in one group; some nulls in group, order and value."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else pick.choice(["a", "b", "c", None])
        order = None if pick.random() < 0.05 else pick.randrange(0, 200)
        value = None if pick.random() < 0.1 else pick.randrange(0, 50)
        rows.append((i, group, order, value))
    return rows


def first_nulls(x):
    return (x is not None, x if x is not None else 0)


@pytest.mark.parametrize("ranges", [1, 2, 7, 64])
@pytest.mark.parametrize("ahead", [False, True])
@pytest.mark.parametrize("grouped", [False, True])
def test_neighbour_equals_brute_force(spark, ranges, ahead, grouped):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "id int, g string, o int, v int").repartition(5)
    group = ["g"] if grouped else []
    got = with_neighbour(df, "v", ["o", "id"], group, "near", ahead, ranges=ranges).collect()

    by_group = {}
    for r in sorted(rows, key=lambda r: (first_nulls(r[2]), r[0])):
        by_group.setdefault(r[1] if grouped else 0, []).append(r)
    expected = {}
    for members in by_group.values():
        for i, r in enumerate(members):
            k = i + 1 if ahead else i - 1
            inside = 0 <= k < len(members)
            expected[r[0]] = (members[k][3] if inside else None, inside)
    assert {r["id"]: (r["near"], r["near_exists"]) for r in got} == expected


def test_ranges_follow_the_order_and_are_even(spark):
    df = spark.range(20_000).select(F.lit("hot").alias("g"), (F.col("id") % 7919).alias("k"), "id")
    sizes = ranged(df, ["g", "k", "id"], 16).groupBy("_range").agg(
        F.count("*").alias("n"), F.min("k").alias("lo"), F.max("k").alias("hi")
    ).orderBy("_range").collect()
    assert len(sizes) == 16
    assert max(s["n"] for s in sizes) < 4 * 20_000 / 16
    assert all(a["hi"] <= b["lo"] for a, b in zip(sizes, sizes[1:]))


def test_a_hot_value_falls_into_one_range_without_losing_rows(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    dealt = ranged(df, ["k"], 10)
    assert dealt.count() == 3000
    assert dealt.where("k = 5").select("_range").distinct().count() == 1


@pytest.mark.parametrize("quantile", [0.0, 0.1, 0.5, 0.9, 1.0])
def test_quantile_equals_numpy(spark, quantile):
    rows = [(r[1], None if r[3] is None else r[3] / 4) for r in hot_rows()]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["q"] for r in exact_quantile(df, "v", quantile, ["g"], "q").collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        assert got[g] == pytest.approx(np.quantile(values, quantile))


def test_quantile_without_groups_and_of_nothing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "v double")
    assert exact_quantile(df, "v", 0.75).first()["quantile"] == 3.0
    assert exact_quantile(df.where("v > 9"), "v", 0.5).first()["quantile"] is None
    with pytest.raises(ValueError):
        exact_quantile(df, "v", 1.5)


ODD = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf")]
ODD += [1.0, 2.0, 4.0, 0.5, 3.0, 1.0000000000000002, 0.9999999999999999, -1.0, -1.0000000000000002, 2.0**52, 2.0**53 - 1, -(2.0**53), 1e-320, 1e22, 0.1, 0.30000000000000004]


def test_codes_sort_like_doubles_and_tell_them_apart(spark):
    rng = np.random.default_rng(8)
    values = sorted({*ODD, *(float(x) for x in rng.normal(size=200)), *(float(np.ldexp(m, int(e))) for m, e in zip(rng.random(300), rng.integers(-1080, 1024, 300)))})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    codes = {r[0]: tuple(r[1:]) for r in with_codes(df, "v", ["c0", "c1", "c2"]).collect()}
    in_order = [codes[v] for v in values]
    assert all(a < b for a, b in zip(in_order, in_order[1:], strict=False))
    nan = with_codes(df.limit(1).withColumn("v", F.lit(float("nan"))), "v", ["c0", "c1", "c2"]).first()
    assert tuple(nan)[1:] > in_order[-1]


@pytest.mark.parametrize("quantile", [0.0, 0.37, 0.5, 1.0])
def test_quantile_of_negative_infinite_and_equal_values(spark, quantile):
    groups = {"odd": ODD, "same": [7.25] * 50, "far": [-1e300, -1e300, 1e300], "down": [-float(i) for i in range(101)], "inf": [float("inf")] * 3 + [1.0]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs] + [("none", None)], "g string, v double")
    got = {r["g"]: r["q"] for r in exact_quantile(df, "v", quantile, ["g"], "q").collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        ordered, at = sorted(vs), (len(vs) - 1) * quantile
        low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
        assert got[g] == (low if low == high else pytest.approx(low + (high - low) * (at - np.floor(at)))), g


def test_quantiles_neither_sort_nor_shuffle_rows(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("g"), F.sqrt("id").alias("v"))
    plan = exact_quantile(df, "v", 0.5, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort " not in plan and "Repartition" not in plan


# --- monotone, sequences, ranges ---------------------------------------------


@pytest.mark.parametrize("ranges", [1, 9])
@pytest.mark.parametrize("strictly", [True, False])
def test_increasing_counts_every_failing_row(spark, ranges, strictly):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "id int, g string, o int, v int")
    got = ev.expect_column_values_to_be_increasing(
        df, "v", "o", strictly, "o is not null and v is not null", ["g"], ranges
    )
    failing = 0
    for g in {r[1] for r in rows}:
        members = sorted((r[2], r[3]) for r in rows if r[1] == g and None not in (r[2], r[3]))
        for (_, a), (_, b) in zip(members, members[1:]):
            failing += not (b > a if strictly else b >= a)
    assert got.agg(F.sum("failing_rows")).first()[0] == failing


def test_monotone_passes_and_fails_on_known_rows(spark):
    rows = [(1, 21, 0.0), (2, 22, 1.0), (2, 23, 2.0), (2, 24, 1.0), (3, 23, 0.5), (4, 23, 0.5)]
    df = spark.createDataFrame(rows, "idx int, day int, a double")
    up = ev.expect_column_values_to_be_increasing(df, "a", "day", group_by=["idx"])
    assert [(r["idx"], r["day"], r["previous"]) for r in up.collect()] == [(2, 24, 2.0)]
    down = ev.expect_column_values_to_be_decreasing(df, "a", "day", group_by=["idx"])
    assert {(r["idx"], r["day"]) for r in down.collect()} == {(2, 23)}
    assert ev.expect_column_values_to_be_increasing(df, "a", "day", row_condition="idx = 1").count() == 0


@pytest.mark.parametrize("ranges", [1, 6])
def test_sequential_values(spark, ranges):
    df = spark.createDataFrame([("a", v) for v in (1, 2, 3, 5, 5, None)] + [("b", 7)], "g string, v int")
    got = {(r["v"], r["previous"]): r["failing_rows"] for r in tt.sequential_values(df, "v", group_by=["g"], ranges=ranges).collect()}
    assert got == {(5, 3): 2}
    assert tt.sequential_values(df.where("v < 4"), "v", group_by=["g"], ranges=ranges).count() == 0


def test_sequential_dates(spark):
    df = spark.sql("select explode(sequence(date'2024-01-01', date'2024-05-01', interval 1 month)) d")
    assert tt.sequential_values(df, "d", 1, "month", ranges=3).count() == 0
    gap = df.where("d <> date'2024-03-01'")
    assert [str(r["d"]) for r in tt.sequential_values(gap, "d", 1, "month", ranges=3).collect()] == ["2024-04-01"]


RANGES = "id int, a int, b int"


@pytest.mark.parametrize("ranges", [1, 5])
@pytest.mark.parametrize(
    "rows, gaps, zero, failing",
    [
        ([(1, 0, 5), (1, 5, 9), (2, 0, 3)], "not_allowed", False, 0),
        ([(1, 0, 5), (1, 6, 9)], "not_allowed", False, 1),
        ([(1, 0, 5), (1, 6, 9)], "allowed", False, 0),
        ([(1, 0, 5), (1, 6, 9)], "required", False, 0),
        ([(1, 0, 5), (1, 5, 9)], "required", False, 1),
        ([(1, 0, 7), (1, 5, 9)], "allowed", False, 1),
        ([(1, 3, 3), (1, 3, 4)], "allowed", True, 0),
        ([(1, 3, 3), (1, 3, 4)], "allowed", False, 1),
        ([(1, 0, 5)] * 3, "allowed", False, 2),
        ([(1, 0, None), (1, 5, 9)], "allowed", False, 1),
        ([(1, None, 4), (1, 5, 9)], "allowed", False, 1),
    ],
)
def test_mutually_exclusive_ranges(spark, ranges, rows, gaps, zero, failing):
    df = spark.createDataFrame(rows, RANGES)
    bad = tt.mutually_exclusive_ranges(df, "a", "b", "id", gaps, zero, ranges)
    assert (bad.agg(F.sum("failing_rows")).first()[0] or 0) == failing


def test_unknown_gap_rule_is_an_error(spark):
    with pytest.raises(ValueError):
        tt.mutually_exclusive_ranges(spark.createDataFrame([(1, 0, 5)], RANGES), "a", "b", gaps="maybe")


# --- joins under hot keys ----------------------------------------------------


@pytest.mark.parametrize("hint", [None, "merge"])
def test_lookup_join_equals_a_plain_left_join(spark, hint):
    rows = hot_rows()
    left = spark.createDataFrame([(r[0], r[1], r[2]) for r in rows], "id int, k string, o int")
    right = spark.createDataFrame([("hot", 1, None), ("a", 2, "x"), ("z", 3, "y")], "k string, n int, t string")
    got = j.lookup_join(left, right.hint(hint) if hint else right, ["k"])
    wanted = left.join(right, "k", "left").select(*got.columns)
    assert got.count() == len(rows)
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0
    with pytest.raises(ValueError, match="o"):
        j.lookup_join(left, right.withColumnRenamed("n", "O"), ["k"])


def test_duplicates_keep_the_first_row(spark):
    rows = [(0, "hot"), (1, "hot"), (2, None), (3, None), (4, "x"), (5, "hot")]
    df = spark.createDataFrame(rows, "id int, k string")
    flags = flag_duplicates_in_batch(df, "k", ["id"], "dup").collect()
    assert {r["id"] for r in flags if r["dup"]} == {1, 5}


@pytest.mark.parametrize("wide", [False, True])
def test_repeated_keys(spark, wide):
    df = spark.createDataFrame([("x", None)] * 3 + [("x", 1), (None, None)] * 1 + [("y", 1)] * 2, "a string, b int")
    got = {(r["a"], r["b"]): r["n_records"] for r in j.repeated_keys(df, ["a", "b"], wide=wide).collect()}
    assert got == {("x", None): 3, ("y", 1): 2}


def test_keys_with_and_without_match(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,), (None,), (2,)], "p int")
    assert [tuple(r) for r in j.keys_without_match(child, "k", parent, "p").collect()] == [(1, 2)]
    assert [tuple(r) for r in j.keys_with_match(child, "k", parent, "p").collect()] == [(2, 1)]
