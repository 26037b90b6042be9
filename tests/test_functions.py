"""Scalar and date columns against golden values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.catalog import QUERIES
from tidemark.functions import dates as d
from tidemark.functions import scalars as s
from tidemark.operators.calendar import get_date_dimension, get_fiscal_periods, get_fiscal_year_dates
from tidemark.operators.reshape import date_spine


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def day(text):
    return F.lit(text).cast("date")


GOLDEN = {
    "2020-11-29": dict(
        name="Sunday", month_day=29, year_day=334, dow=1, iso_dow=7,
        week=("2020-11-29", "2020-12-05"), iso_week=("2020-11-23", "2020-11-29"),
        woy=48, iso_woy=48, month="November", before="2020-11-28", after="2020-11-30",
    ),
    "2020-12-01": dict(
        name="Tuesday", month_day=1, year_day=336, dow=3, iso_dow=2,
        week=("2020-11-29", "2020-12-05"), iso_week=("2020-11-30", "2020-12-06"),
        woy=48, iso_woy=49, month="December", before="2020-11-30", after="2020-12-02",
    ),
}


@pytest.mark.parametrize("text", GOLDEN)
def test_golden_days(spark, text):
    want, x = GOLDEN[text], day(text)
    got = spark.range(1).select(
        d.day_name(x, short=False), d.day_name(x), d.day_of_month(x), d.day_of_year(x),
        d.day_of_week(x, isoweek=False), d.day_of_week(x),
        d.week_start(x).cast("string"), d.week_end(x).cast("string"),
        d.iso_week_start(x).cast("string"), d.iso_week_end(x).cast("string"),
        d.week_of_year(x), d.iso_week_of_year(x), d.month_name(x, short=False), d.month_name(x),
        d.yesterday(x).cast("string"), d.tomorrow(x).cast("string"),
    ).first()
    assert tuple(got) == (
        want["name"], want["name"][:3], want["month_day"], want["year_day"], want["dow"], want["iso_dow"],
        *want["week"], *want["iso_week"], want["woy"], want["iso_woy"], want["month"], want["month"][:3],
        want["before"], want["after"],
    )


def test_epochs_and_zones(spark):
    at = d.from_unixtimestamp(F.lit(1700000000))
    assert one(spark, at.cast("string")) == "2023-11-14 22:13:20"
    assert one(spark, d.to_unixtimestamp(at)) == 1700000000
    local = d.convert_timezone(at, "Pacific/Pago_Pago")
    assert one(spark, local.cast("string")) == "2023-11-14 11:13:20"
    assert one(spark, d.round_timestamp(at).cast("string")) == "2023-11-15 00:00:00"
    assert one(spark, d.round_timestamp(local).cast("string")) == "2023-11-14 00:00:00"
    millis = d.from_unixtimestamp(F.lit(1700000000250), "milliseconds")
    assert one(spark, millis.cast("string")) == "2023-11-14 22:13:20.25"
    with pytest.raises(ValueError):
        d.from_unixtimestamp(F.lit(1), "weeks")


def test_relative_periods(spark):
    x = day("2024-03-31")
    got = spark.range(1).select(
        *[c.cast("string") for c in (
            d.n_days_ago(1, x), d.n_days_away(1, x), d.n_weeks_ago(1, x), d.n_weeks_away(1, x),
            d.n_months_ago(1, x), d.n_months_away(1, x), d.last_week(x), d.next_week(x), d.last_month(x), d.next_month(x),
            d.last_month_name(x), d.next_month_name(x, short=False), d.last_month_number(x), d.next_month_number(x),
        )]
    ).first()
    assert tuple(got) == (
        "2024-03-30", "2024-04-01", "2024-03-18", "2024-04-01", "2024-02-01", "2024-04-01",
        "2024-03-18", "2024-04-01", "2024-02-01", "2024-04-01", "Feb", "April", "2", "4",
    )


@pytest.mark.parametrize(
    "part, n",
    [("day", 1), ("week", 0), ("month", 1), ("quarter", 0), ("year", 0), ("hour", 2), ("minute", 61), ("second", 3660)],
)
def test_boundaries_between(spark, part, n):
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-31 23:00:00", "2024-02-01 00:01:00"))
    if part == "hour":
        n = 1
    assert one(spark, d.get_intervals_between(start, end, part)) == n
    with pytest.raises(ValueError):
        d.get_intervals_between(start, end, "decade")


def test_periods_since_and_clock(spark):
    at = F.lit("2024-01-31 20:00:00").cast("timestamp")
    assert one(spark, d.periods_since(day("2024-01-01"), at)) == 30
    assert one(spark, d.now(at, "Asia/Tokyo").cast("string")) == "2024-02-01 05:00:00"
    assert one(spark, d.today(at, "Asia/Tokyo")) == dt.date(2024, 2, 1)
    assert one(spark, d.today(at)) == dt.date(2024, 1, 31)
    assert one(spark, d.now()) is not None


# --- calendar ----------------------------------------------------------------


@pytest.fixture(scope="module")
def dimension(spark):
    return get_date_dimension(date_spine(spark, "day", "2015-01-01", "2022-12-31")).cache()


def test_dimension_has_36_columns_and_excludes_the_end(dimension):
    assert len(dimension.columns) == 36
    assert dimension.count() == 2921
    leap = dimension.where("date_day = '2020-02-29'").first()
    assert leap["prior_year_date_day"] == dt.date(2019, 2, 28)
    assert leap["prior_year_over_year_date_day"] == dt.date(2019, 3, 2)
    assert leap["quarter_end_date"] == dt.date(2020, 3, 31)
    assert leap["year_end_date"] == dt.date(2020, 12, 31)
    assert leap["prior_year_month_end_date"] == dt.date(2019, 2, 28)


def test_fiscal_years_have_whole_weeks(dimension):
    years = get_fiscal_year_dates(dimension, 1, 1, 1)
    weeks = {
        r["fiscal_year_number"]: (r["n"], str(r["a"]), str(r["b"]))
        for r in years.groupBy("fiscal_year_number").agg(
            F.max("fiscal_week_of_year").alias("n"), F.min("date_day").alias("a"), F.max("date_day").alias("b")
        ).collect()
    }
    # The retail calendar of 2017 had 53 weeks and ended on 3 February 2018.
    assert weeks[2017] == (53, "2017-01-29", "2018-02-03")
    assert weeks[2018] == (52, "2018-02-04", "2019-02-02")
    assert 2014 not in weeks


def test_fiscal_periods_are_4_5_4(dimension):
    periods = get_fiscal_periods(dimension, 1, 1, 1)
    sizes = [
        r["n"] // 7
        for r in periods.where("fiscal_year_number = 2018").groupBy("fiscal_period_number").agg(F.count("*").alias("n"))
        .orderBy("fiscal_period_number").collect()
    ]
    assert sizes == [4, 5, 4] * 4
    last = periods.where("fiscal_year_number = 2017 and fiscal_week_of_year = 53").first()
    assert (last["fiscal_period_number"], last["fiscal_quarter_number"], last["fiscal_period_of_quarter"]) == (12, 4, 3)
    assert last["fiscal_week_of_period"] == 5


# --- scalars -----------------------------------------------------------------


def test_null_safe_arithmetic(spark):
    null = F.lit(None).cast("int")
    assert one(spark, s.safe_add([F.lit(1), null, F.lit(2)])) == 3
    assert one(spark, s.safe_subtract([F.lit(5), null, F.lit(2)])) == 3
    assert one(spark, s.safe_divide(F.lit(6), F.lit(0))) is None
    assert one(spark, s.safe_divide(F.lit(6), F.lit(4))) == 1.5
    assert one(spark, s.safe_divide(null, F.lit(4))) is None
    with pytest.raises(ValueError):
        s.safe_add([])


@pytest.mark.parametrize("value, bucket", [(-1, 0), (0, 1), (9.99, 1), (10, 2), (99, 10), (100, 11), (500, 11)])
def test_width_bucket(spark, value, bucket):
    assert one(spark, s.width_bucket(F.lit(value), 0, 100, 10)) == bucket


def test_haversine(spark):
    ends = [F.lit(v) for v in (40.7128, -74.0060, 51.5074, -0.1278)]
    miles = one(spark, s.haversine_distance(*ends))
    assert miles == pytest.approx(3463, abs=5)
    assert one(spark, s.haversine_distance(*ends, unit="km")) == pytest.approx(miles * 1.60934)
    assert one(spark, s.degrees_to_radians(F.lit(180))) == pytest.approx(math.pi)
    with pytest.raises(ValueError):
        s.haversine_distance(*ends, unit="ft")


@pytest.mark.parametrize(
    "url, host, path",
    [
        ("https://www.x.com:80/a/b?q=1", "www.x.com:80", "a/b"),
        ("http://x.com?q=1", "x.com", ""),
        ("android-app://m.x.com/p", "m.x.com", "/m.x.com/p"),
        ("x.com", "x.com", "x.com"),
        ("https://x.com/", "x.com", ""),
        ("https://u:p@x.com/a", "u:p@x.com", "a"),
        (None, None, None),
    ],
)
def test_url_host_and_path(spark, url, host, path):
    assert one(spark, s.get_url_host(F.lit(url).cast("string"))) == host
    assert one(spark, s.get_url_path(F.lit(url).cast("string"))) == path


def test_url_parameter(spark):
    url = F.lit("https://x.com/?utm_source=a&utm_medium=&z=1")
    values = [one(spark, s.get_url_parameter(url, p)) for p in ("utm_source", "utm_medium", "z", "none")]
    assert values == ["a", None, "1", None]


def test_masks(spark):
    assert one(spark, s.mask_partial(F.lit("11987654321"))) == "1198***4321"
    assert one(spark, s.mask_partial(F.lit("12345678"))) == "***"
    assert one(spark, s.mask_partial(F.lit("abcdef"), 1, 1)) == "a***f"
    assert one(spark, s.mask_partial(F.lit(None).cast("string"))) is None
    assert one(spark, s.mask_email(F.lit(" a@b.c "))) == one(spark, s.pii_hash(F.lit("a@b.c")))
    assert one(spark, s.mask_email(F.lit(None).cast("string"))) is None
    assert one(spark, s.generalize_age(day("1985-06-30"), day("2024-01-01"))) == 30


def test_surrogate_keys_tell_null_from_blank(spark):
    key = lambda v: one(spark, s.generate_surrogate_key([F.lit("a"), F.lit(v).cast("string")]))
    assert len({key(None), key(""), key("b")}) == 3 and key("b") == key("b")


def test_regexp_positions(spark):
    text = F.lit("ab12cd345")
    assert one(spark, s.regexp_instr(text, "[0-9]+")) == 3
    assert one(spark, s.regexp_instr(text, "[0-9]+", occurrence=2)) == 7
    assert one(spark, s.regexp_instr(text, "[0-9]+", occurrence=3)) == 0
    assert one(spark, s.regexp_instr(text, "[0-9]+", position=4)) == 4
    assert one(spark, s.regexp_instr(text, "CD", flags="i")) == 5
    assert one(spark, s.regexp_instr(F.lit(None).cast("string"), "a")) is None


def test_metric_expression(spark):
    assert one(spark, s.metric_expression(F.lit(0.0), True)) == 0.0
    assert one(spark, s.metric_expression(F.lit(math.e), True)) == pytest.approx(1)
    assert one(spark, s.metric_expression(F.lit(None).cast("double"), False)) == 0
    assert one(spark, s.log_natural(F.lit(-1.0))) is None
    assert 0 <= one(spark, s.random_uniform(1)) < 1


def test_a_few_equal_draws_are_different_enough(spark, monkeypatch, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/events.parquet")
    for draw, different in ((F.greatest("id", F.lit(1)) / 1001, True), (F.floor(F.col("id") / 2) / 1001, False)):
        monkeypatch.setattr(s, "random_uniform", lambda seed, draw=draw: draw)
        assert QUERIES["rand"](spark, str(tmp_path)).first()["all_different"] is different
