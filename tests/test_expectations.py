"""Each expectation with a passing and a failing case, on a small table of deliveries."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.operators import core, expect_aggregates as ea, expect_shape as es
from tidemark.operators import expect_time as et
from tidemark.operators import expect_values as ev

COLUMNS = (
    "idx int, date_col string, a double, b double, s string, t string, n1 string, n2 string, a_plus_b decimal(3,1)"
)
ROWS = [
    (10, "2022-03-05", 2.0, 8.0, "dock", "k", None, None, 10),
    (20, "2022-03-05", 8.0, 2.0, "yard", "kl", None, None, 10),
    (30, "2022-03-06", 4.0, 6.0, "gate", "klm", None, None, 10),
    (40, "2022-03-06", 4.0, 6.0, "gate", "klmno", None, None, 10),
    (50, "2022-03-09", 7.0, 3.0, "pier", "klmnop", None, None, 10),
]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(*r[:-1], Decimal(r[-1])) for r in ROWS], COLUMNS).cache()


@pytest.fixture(scope="module")
def mail(spark):
    names = ["kim@post.example", "ola@box.example", "ole.berg@post.example"]
    return spark.createDataFrame([(n,) for n in names], "e string").cache()


def n(failing):
    return failing.count()


@pytest.mark.parametrize(
    "expectation, column, good, bad",
    [
        ("max", "a", (8, 8), (2, 7)),
        ("min", "a", (1, 2), (2.5, 8)),
        ("mean", "a", (5, 5), (5.5, 6)),
        ("median", "a", (4, 4), (4.5, 7)),
        ("sum", "a", (20, 25), (26, 30)),
        ("stdev", "a", (2.4, 2.5), (2.5, 3)),
        ("unique_value_count", "a", (4, 4), (5, 9)),
        ("proportion_of_unique_values", "a", (0, 0.8), (0, 0.75)),
    ],
)
def test_aggregates_between(df, expectation, column, good, bad):
    check = getattr(ea, f"expect_column_{expectation}_to_be_between")
    assert n(check(df, column, *good)) == 0
    assert n(check(df, column, *bad)) == 1
    assert n(check(df, column, *good, row_condition="idx > 0")) == 0


def test_bounds_are_needed_and_can_be_strict(df):
    with pytest.raises(ValueError):
        ea.expect_column_max_to_be_between(df, "a")
    assert n(ea.expect_column_max_to_be_between(df, "a", max_value=8, strictly=True)) == 1
    assert n(ea.expect_column_max_to_be_between(df, "a", max_value=8, group_by=["idx"])) == 0


def test_quantile(df):
    assert n(ea.expect_column_quantile_values_to_be_between(df, "a", 0.75, 6.5, 7.5)) == 0
    assert n(ea.expect_column_quantile_values_to_be_between(df, "a", 0.75, 7.5, 8)) == 1


def test_distinct_counts(df):
    assert n(ea.expect_column_distinct_count_to_equal(df, "a", 4)) == 0
    assert n(ea.expect_column_distinct_count_to_equal(df, "a", 5)) == 1
    assert n(ea.expect_column_distinct_count_to_be_greater_than(df, "a", 3)) == 0
    assert n(ea.expect_column_distinct_count_to_be_greater_than(df, "a", 4)) == 1
    assert n(ea.expect_column_distinct_count_to_be_less_than(df, "a", 5)) == 0
    assert n(ea.expect_column_distinct_count_to_be_less_than(df, "a", 4)) == 1
    assert n(ea.expect_column_distinct_count_to_equal_other_table(df, "a")) == 0
    assert n(ea.expect_column_distinct_count_to_equal_other_table(df, "a", df, "t")) == 1


def test_distinct_values_against_sets(df):
    values = lambda f: sorted(r["value_field"] or "null" for r in f.collect())
    assert values(ea.expect_column_distinct_values_to_be_in_set(df, "s", ["dock", "yard", "gate", "pier", "ramp"])) == []
    assert values(ea.expect_column_distinct_values_to_be_in_set(df, "s", ["dock", "pier"])) == ["gate", "yard"]
    assert values(ea.expect_column_distinct_values_to_be_in_set(df, "n1", ["a"])) == ["null"]
    assert values(ea.expect_column_distinct_values_to_contain_set(df, "s", ["dock", "gate"])) == []
    assert values(ea.expect_column_distinct_values_to_contain_set(df, "s", ["dock", "ramp"])) == ["ramp"]
    assert values(ea.expect_column_distinct_values_to_equal_set(df, "s", ["dock", "gate", "pier", "yard"])) == []
    assert values(ea.expect_column_distinct_values_to_equal_set(df, "s", ["dock", "gate", "ramp", "yard"])) == ["pier", "ramp"]
    assert values(ea.expect_column_distinct_values_to_equal_set(df, "n1", ["a"])) == ["a", "null"]


def test_most_common_value_is_the_nth_not_the_first_n(df):
    assert n(ea.expect_column_most_common_value_to_be_in_set(df, "a", [4.0])) == 0
    assert n(ea.expect_column_most_common_value_to_be_in_set(df, "a", [8.0])) == 1
    assert n(ea.expect_column_most_common_value_to_be_in_set(df, "a", [2.0], top_n=2)) == 0
    assert n(ea.expect_column_most_common_value_to_be_in_set(df, "a", [4.0], top_n=2)) == 1
    assert n(ea.expect_column_most_common_value_to_be_in_set(df, "a", [], top_n=9)) == 0


# --- core --------------------------------------------------------------------


def test_expression_rows_groups_and_nulls(df):
    assert n(core.expression_is_true(df, "a + b = 10")) == 0
    assert n(core.expression_is_true(df, "a > 2")) == 1
    assert n(core.expression_is_true(df, "n1 = 'x'")) == 0
    assert n(core.expression_is_true(df, "count(*) = 1", ["date_col"])) == 2
    assert n(core.expression_is_true(df, "sum(a) + sum(b) = 50", aggregated=True)) == 0
    assert n(core.expression_is_true(df, "sum(a) = 4", aggregated=True)) == 1


def test_equal_expression(df, spark):
    total, rows = F.sum("a"), F.count(F.lit(1))
    assert n(core.equal_expression(df, total, compare_expression=F.sum("b"))) == 0
    assert n(core.equal_expression(df, total, compare_expression=rows)) == 1
    assert n(core.equal_expression(df, total, compare_expression=rows, tolerance=20)) == 0
    fewer = df.where("idx < 50")
    one_sided = core.equal_expression(df, rows, fewer, rows, ["idx"]).collect()
    assert [(r["col_1"], r["expression"], r["compare_expression"]) for r in one_sided] == [(50, 1, None)]
    missing_first = core.equal_expression(fewer, rows, df, rows, ["idx"], tolerance_percent=0.1)
    assert n(missing_first) == 0
    assert n(core.equal_expression(df, rows, fewer, rows, ["idx"], tolerance_percent=0.1)) == 1


def test_null_groups_do_not_meet(spark):
    a = spark.createDataFrame([(None,), (1,)], "k int")
    rows = F.count(F.lit(1))
    assert n(core.equal_expression(a, rows, a, rows, ["k"])) == 2


# --- values ------------------------------------------------------------------


def test_values(df):
    assert n(ev.expect_column_values_to_be_between(df, "a", 2, 8)) == 0
    assert n(ev.expect_column_values_to_be_between(df, "a", 2, 8, strictly=True)) == 2
    assert n(ev.expect_column_values_to_be_between(df, "n1", "a", "b")) == 0
    assert n(ev.expect_column_values_to_be_in_set(df, "s", ["dock", "gate", "pier", "yard"])) == 0
    assert n(ev.expect_column_values_to_be_in_set(df, "s", ["dock"])) == 4
    assert n(ev.expect_column_values_to_be_in_set(df, "n1", ["dock"])) == 5
    assert n(ev.expect_column_values_to_not_be_in_set(df, "s", ["ramp"])) == 0
    assert n(ev.expect_column_values_to_not_be_in_set(df, "s", ["gate"])) == 2
    assert n(ev.expect_column_values_to_not_be_in_set(df, "n1", ["gate"])) == 0
    assert n(ev.expect_column_values_to_be_null(df, "n1")) == 0
    assert n(ev.expect_column_values_to_be_null(df, "s")) == 5
    assert n(ev.expect_column_values_to_not_be_null(df, "s")) == 0
    assert n(ev.expect_column_values_to_not_be_null(df, "n1", "idx = 10")) == 1
    assert n(ev.expect_column_values_to_be_unique(df, "t")) == 0
    assert n(ev.expect_column_values_to_be_unique(df, "s")) == 1


def test_casing(spark):
    clean = spark.createDataFrame([("a",), ("b",), ("a",)], "s string")
    mixed = spark.createDataFrame([("a",), ("A",), ("b",)], "s string")
    null = spark.createDataFrame([("a",), (None,)], "s string")
    check = ev.expect_column_values_to_have_consistent_casing
    assert n(check(clean, "s")) == 0 and n(check(mixed, "s")) == 1 and n(check(null, "s")) == 1
    listed = check(mixed, "s", display_inconsistent_columns=True).collect()
    assert [tuple(r) for r in listed] == [("a", 2)]


# --- several columns ---------------------------------------------------------


def test_pairs(df):
    greater = ev.expect_column_pair_values_A_to_be_greater_than_B
    assert n(greater(df, "a", "b", row_condition="idx = 20")) == 0
    assert n(greater(df, "a", "b")) == 3
    assert n(greater(df, "a", "b", or_equal=True)) == 3
    assert n(greater(df, "n1", "b")) == 0
    assert n(ev.expect_column_pair_values_to_be_equal(df, "a", "a")) == 0
    assert n(ev.expect_column_pair_values_to_be_equal(df, "a", "b")) == 5
    in_set = ev.expect_column_pair_values_to_be_in_set
    assert n(in_set(df, "a", "b", [(2, 8), (8, 2), (4, 6), (7, 3), (4, 6)])) == 0
    assert n(in_set(df, "a", "b", [(4, 6)])) == 3
    with pytest.raises(ValueError):
        in_set(df, "a", "b", [(4, 6, 8)])


def test_compound_unique_depends_on_the_rows_ignored(df):
    check = ev.expect_compound_columns_to_be_unique
    assert n(check(df, ["date_col", "t"])) == 0
    assert n(check(df, ["date_col", "s"])) == 1
    assert n(check(df, ["date_col", "n1"])) == 2
    assert n(check(df, ["date_col", "n1"], "any_value_is_missing")) == 0
    assert n(check(df, ["n1", "n2"])) == 0
    with pytest.raises(ValueError):
        check(df, ["s"], "never")


def test_sums(df):
    assert n(ev.expect_multicolumn_sum_to_equal(df, ["a", "b"], 50)) == 0
    assert n(ev.expect_multicolumn_sum_to_equal(df, ["a", "b"], 55)) == 1
    assert n(ev.expect_multicolumn_sum_to_equal(df, ["a", "b"], "a_plus_b", ["idx"])) == 0
    assert n(ev.expect_multicolumn_sum_to_equal(df, ["a"], "b", ["idx"])) == 5


def test_unique_within_record(df):
    check = ev.expect_select_column_values_to_be_unique_within_record
    assert n(check(df, ["idx", "s"])) == 0
    assert n(check(df, ["a", "b"])) == 0
    assert n(check(df.withColumn("c", F.col("a")), ["a", "c"])) == 5
    # A null is no distinct value, so a row with one is short of a value.
    assert n(check(df, ["s", "n1"])) == 5
    assert n(check(df, ["s", "n1"], "any_value_is_missing")) == 0
    assert n(check(df, ["n1", "n2"])) == 0


# --- strings -----------------------------------------------------------------


def test_lengths(df):
    assert n(ev.expect_column_value_lengths_to_be_between(df, "t", 1, 6)) == 0
    assert n(ev.expect_column_value_lengths_to_be_between(df, "t", 2, 5)) == 2
    assert n(ev.expect_column_value_lengths_to_equal(df, "s", 4)) == 0
    assert n(ev.expect_column_value_lengths_to_equal(df, "t", 3)) == 4


def test_patterns(mail):
    assert n(ev.expect_column_values_to_match_regex(mail, "e", "^[a-z.]+@")) == 0
    assert n(ev.expect_column_values_to_match_regex(mail, "e", "^[0-9]")) == 3
    assert n(ev.expect_column_values_to_not_match_regex(mail, "e", "^[0-9]")) == 0
    assert n(ev.expect_column_values_to_not_match_regex(mail, "e", "box|post")) == 3
    assert n(ev.expect_column_values_to_match_regex(mail, "e", "KIM|OL")) == 3
    assert n(ev.expect_column_values_to_match_regex(mail, "e", "KIM|OL", flags="i")) == 0
    with pytest.raises(ValueError):
        ev.expect_column_values_to_match_regex(mail, "e", "a", flags="q")
    regexes, likes = ["@post", "@box"], ["%@post%", "%@box%"]
    assert n(ev.expect_column_values_to_match_regex_list(mail, "e", regexes)) == 0
    assert n(ev.expect_column_values_to_match_regex_list(mail, "e", regexes, "all")) == 3
    assert n(ev.expect_column_values_to_not_match_regex_list(mail, "e", regexes)) == 0
    assert n(ev.expect_column_values_to_not_match_regex_list(mail, "e", regexes, "all")) == 3
    assert n(ev.expect_column_values_to_match_like_pattern(mail, "e", "%.example")) == 0
    assert n(ev.expect_column_values_to_match_like_pattern(mail, "e", "x%")) == 3
    assert n(ev.expect_column_values_to_not_match_like_pattern(mail, "e", "x%")) == 0
    assert n(ev.expect_column_values_to_not_match_like_pattern(mail, "e", "%@%")) == 3
    assert n(ev.expect_column_values_to_match_like_pattern_list(mail, "e", likes)) == 0
    assert n(ev.expect_column_values_to_match_like_pattern_list(mail, "e", likes, "all")) == 3
    assert n(ev.expect_column_values_to_not_match_like_pattern_list(mail, "e", likes, "any")) == 0
    assert n(ev.expect_column_values_to_not_match_like_pattern_list(mail, "e", likes, "all")) == 3
    with pytest.raises(ValueError):
        ev.expect_column_values_to_match_regex_list(mail, "e", regexes, "some")


# --- time --------------------------------------------------------------------


@pytest.fixture(scope="module")
def series(spark):
    days = spark.sql(
        "select explode(sequence(date'2023-01-01', date'2023-03-31', interval 1 day)) as day, explode(array(1, 2, 3, 4)) as g"
    )
    # A steady pattern with some variation.
    return days.withColumn("v", 100.0 + F.pmod(F.dayofyear("day") * 7 + F.col("g"), F.lit(11))).cache()


AS_OF = "2023-04-01 12:00:00"


def test_moving_stdevs(series):
    check = et.expect_column_values_to_be_within_n_moving_stdevs
    assert n(check(series, "v", "day", AS_OF, sigma_threshold=6)) == 0
    spike = series.withColumn("v", F.when((F.col("day") == "2023-03-25") & (F.col("g") == 2), 9000.0).otherwise(F.col("v")))
    failing = check(spike, "v", "day", AS_OF, ["g"], sigma_threshold=6).collect()
    assert {(r["g"], str(r["metric_period"])[:10]) for r in failing} == {(2, "2023-03-25")}
    plain = check(spike, "v", "day", AS_OF, sigma_threshold=6, take_diffs=False, take_logs=False).collect()
    assert [str(r["metric_period"])[:10] for r in plain] == ["2023-03-25"]
    assert n(check(spike, "v", "day", AS_OF, ["g"], test_periods=3, sigma_threshold=6)) == 0


def test_stdevs_of_group_sums(series):
    check = et.expect_column_values_to_be_within_n_stdevs
    assert n(check(series, "v", ["day"], 6)) == 0
    spike = series.withColumn("v", F.when(F.col("day") == "2023-03-25", 9000.0).otherwise(F.col("v")))
    assert [str(r["day"]) for r in check(spike, "v", ["day"], 6).collect()] == ["2023-03-25"]
    assert n(check(spike, "v", sigma_threshold=0.1)) == 0


def test_gaps(series):
    check = et.expect_row_values_to_have_data_for_every_n_datepart
    days = lambda f: [str(r["date_day"])[:10] for r in f.orderBy("date_day").collect()]
    assert days(check(series, "day")) == []
    gap = series.where("day <> '2023-02-10' and day <> '2023-03-31'")
    assert days(check(gap, "day")) == ["2023-02-10"]
    assert days(check(gap, "day", exclusion_condition="date_day <> '2023-02-10'")) == []
    # The end of the spine is not included, so a missing last day goes unseen.
    assert days(check(gap, "day", test_end_date="2023-04-01")) == ["2023-02-10", "2023-03-31"]
    assert days(check(gap, "day", interval=2)) == []
    assert days(check(gap.where("day not between '2023-02-08' and '2023-02-12'"), "day", interval=2)) == ["2023-02-08", "2023-02-10"]
    assert n(check(gap.where("false"), "day")) == 0
    assert days(check(gap, "day", row_condition="day < '2023-01-05'")) == []


@pytest.mark.parametrize("first", ["2023-01-15", "2023-01-18", "2023-02-28"])
@pytest.mark.parametrize("part", ["week", "month", "quarter", "year"])
@pytest.mark.parametrize("interval", [None, 2])
def test_no_gaps_where_the_first_day_lies_inside_its_period(spark, first, part, interval):
    check = et.expect_row_values_to_have_data_for_every_n_datepart
    days = spark.range(900).select(F.date_add(F.lit(first).cast("date"), F.col("id").cast("int")).alias("day"))
    assert n(check(days, "day", part, interval)) == 0
    hole = days.where("day NOT BETWEEN '2024-03-20' AND '2024-08-10'")
    if part in ("week", "month"):
        assert n(check(hole, "day", part, interval)) > 0


def test_recent_data(series):
    grouped = et.expect_grouped_row_values_to_have_recent_data
    assert n(grouped(series, ["g"], "day", "day", 2, AS_OF)) == 0
    stale = series.where("g <> 3 or day < '2023-03-01'")
    assert [r["g"] for r in grouped(stale, ["g"], "day", "day", 2, AS_OF).collect()] == [3]
    whole = et.expect_row_values_to_have_recent_data
    assert n(whole(stale, "day", "day", 2, AS_OF)) == 0
    assert n(whole(stale, "day", "day", 2, AS_OF, "g = 3")) == 1
    assert n(whole(stale, "day", "day", 2, AS_OF, "g = 99")) == 1
    future = series.withColumn("day", F.date_add("day", 365))
    assert n(whole(future, "day", "day", 2, AS_OF)) == 1


def test_recency_and_freshness(series):
    assert n(et.recency(series, "day", "day", 2, AS_OF)) == 0
    assert n(et.recency(series, "day", "hour", 6, AS_OF)) == 1
    assert n(et.recency(series.where("false"), "day", "day", 2, AS_OF)) == 0
    status = lambda at: et.source_freshness(series, "day", at).first()["status"]
    assert [status(f"2023-03-31 {h}:00:00") for h in ("10", "13")] == ["pass", "warn"]
    assert status("2023-04-01 01:00:00") == "error"


# --- shape -------------------------------------------------------------------


def test_shape(df):
    names = df.columns
    assert es.expect_column_to_exist(df, "IDX") == [] and es.expect_column_to_exist(df, "zz") == ["zz"]
    assert es.expect_column_to_exist(df, "a", 3) == [] and es.expect_column_to_exist(df, "a", 2) == ["a"]
    assert es.expect_column_to_exist(df, "a", 0) == []
    assert es.expect_column_to_exist(df, "A", transform=str) == ["A"]
    assert es.expect_table_column_count_to_equal(df, 9) == [] and es.expect_table_column_count_to_equal(df, 8) == [9]
    assert es.expect_table_column_count_to_be_between(df, 1, 9) == []
    assert es.expect_table_column_count_to_be_between(df, 10) == [9]
    assert es.expect_table_column_count_to_be_between(df, 0, 0) == []
    assert es.expect_table_column_count_to_equal_other_table(df, df) == []
    assert es.expect_table_column_count_to_equal_other_table(df, df.select("a")) == [9]
    assert es.expect_table_columns_to_contain_set(df, ["a", "B"]) == []
    assert es.expect_table_columns_to_contain_set(df, ["a", "zz"]) == ["zz"]
    assert es.expect_table_columns_to_not_contain_set(df, ["zz"]) == []
    assert es.expect_table_columns_to_not_contain_set(df, ["a", "zz"]) == ["a"]
    assert es.expect_table_columns_to_match_set(df, names[::-1]) == []
    assert es.expect_table_columns_to_match_set(df, names[1:]) == ["IDX"]
    assert es.expect_table_columns_to_match_ordered_list(df, names) == []
    assert len(es.expect_table_columns_to_match_ordered_list(df, [names[1], names[0], *names[2:]])) == 4
    assert es.expect_column_values_to_be_of_type(df, "a", "double") == []
    assert es.expect_column_values_to_be_in_type_list(df, "a", ["INT", "BIGINT"]) == ["DOUBLE"]


def test_row_counts(df):
    assert n(es.expect_table_row_count_to_equal(df, 5)) == 0
    assert n(es.expect_table_row_count_to_equal(df, 1, ["date_col"])) == 2
    assert n(es.expect_table_row_count_to_be_between(df, 1, 5)) == 0
    assert n(es.expect_table_row_count_to_be_between(df, 1, 5, strictly=True)) == 1
    double = df.union(df)
    assert n(es.expect_table_row_count_to_equal_other_table(df, df)) == 0
    assert n(es.expect_table_row_count_to_equal_other_table(df, double)) == 1
    assert n(es.expect_table_row_count_to_equal_other_table_times_factor(double, df, 2)) == 0
    assert n(es.expect_table_row_count_to_equal_other_table_times_factor(double, df, 3, group_by=["idx"])) == 5
    assert n(es.expect_table_aggregation_to_equal_other_table(df, F.sum("a"), double)) == 1
