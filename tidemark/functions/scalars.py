"""Scalar column expressions: null-safe arithmetic, masking, URLs, distance, keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934

NULL_TOKEN = "_null_"


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _zero_if_null(value: ColumnLike) -> Column:
    return F.coalesce(as_column(value), F.lit(0))


def safe_add(columns: Sequence[ColumnLike]) -> Column:
    """Sum of the columns, a null counting as 0."""
    if not columns:
        raise ValueError("safe_add needs at least one column")
    return reduce(lambda a, b: a + b, map(_zero_if_null, columns))


def safe_subtract(columns: Sequence[ColumnLike]) -> Column:
    """First column minus all others, a null counting as 0."""
    if not columns:
        raise ValueError("safe_subtract needs at least one column")
    return reduce(lambda a, b: a - b, map(_zero_if_null, columns))


def safe_divide(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """Quotient, null where the denominator is 0 or null."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def width_bucket(value: ColumnLike, low, high, buckets: int) -> Column:
    """Equi-width bucket number: 0 below ``low``, ``buckets + 1`` from ``high`` on.

    A value on an inner edge opens the next bucket.
    """
    if buckets < 1:
        raise ValueError("width_bucket needs at least one bucket")
    return F.width_bucket(
        as_column(value).cast("double"),
        F.lit(low).cast("double"),
        F.lit(high).cast("double"),
        F.lit(buckets).cast("bigint"),
    )


def degrees_to_radians(degrees: ColumnLike) -> Column:
    return F.radians(as_column(degrees))


def haversine_distance(
    lat1: ColumnLike, lon1: ColumnLike, lat2: ColumnLike, lon2: ColumnLike, unit: str = "mi"
) -> Column:
    """Great-circle distance between two points given in degrees."""
    factors = {"mi": 1.0, "km": KM_PER_MILE}
    if unit not in factors:
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    phi1, phi2 = degrees_to_radians(lat1), degrees_to_radians(lat2)
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (degrees_to_radians(lon2) - degrees_to_radians(lon1)) / 2
    chord = F.pow(F.sin(half_dphi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), 2)
    return F.lit(2.0 * EARTH_RADIUS_MILES * factors[unit]) * F.asin(F.least(F.sqrt(chord), F.lit(1.0)))


def log_natural(value: ColumnLike) -> Column:
    """Natural logarithm, null for values that have none."""
    return F.ln(as_column(value))


def random_uniform(seed: int) -> Column:
    """Uniform 0..1, repeatable for a given partitioning; for fixtures only."""
    return F.rand(seed)


def metric_expression(metric: ColumnLike, take_logs: bool) -> Column:
    """A metric with gaps as 0, on a log scale if asked for (log of 0 counts as 0)."""
    metric = as_column(metric)
    if take_logs:
        return F.coalesce(F.ln(F.nullif(metric, F.lit(0))), F.lit(0.0))
    return F.coalesce(metric, F.lit(0))


def nullcheck(value: ColumnLike) -> Column:
    """Empty string to null."""
    return F.nullif(as_column(value), F.lit(""))


# --- masking -----------------------------------------------------------------


def pii_hash(value: ColumnLike) -> Column:
    """SHA-256 hex of the value's text; null stays null."""
    return F.sha2(as_column(value).cast("string"), 256)


def mask_email(value: ColumnLike) -> Column:
    """SHA-256 hex of the trimmed text; null stays null."""
    return F.sha2(F.trim(as_column(value)), 256)


def mask_partial(value: ColumnLike, visible_prefix: int = 4, visible_suffix: int = 4) -> Column:
    """Keep both ends and hide the middle; short values are hidden whole."""
    value = as_column(value)
    masked = F.concat(
        F.left(value, F.lit(visible_prefix)), F.lit("***"), F.right(value, F.lit(visible_suffix))
    )
    short = F.length(value) <= visible_prefix + visible_suffix
    return F.when(value.isNull(), F.lit(None)).when(short, F.lit("***")).otherwise(masked)


def generalize_age(birth_date: ColumnLike, as_of: ColumnLike) -> Column:
    """Lower end of the ten-year age band at ``as_of``."""
    months = F.months_between(as_column(as_of), as_column(birth_date))
    return (F.floor(months / 120) * 10).cast("int")


# --- urls --------------------------------------------------------------------


def _without(value: Column, *prefixes: str) -> Column:
    return reduce(lambda v, p: F.replace(v, F.lit(p), F.lit("")), prefixes, value)


def _before(value: Column, mark: str) -> Column:
    return F.split_part(value, F.lit(mark), F.lit(1))


def get_url_host(url: ColumnLike) -> Column:
    """Host with port and user info, scheme removed."""
    bare = _without(as_column(url), "android-app://", "http://", "https://")
    return _before(_before(bare, "/"), "?")


def get_url_path(url: ColumnLike) -> Column:
    """Text after the host's slash up to the query; a URL with neither comes back whole."""
    bare = _without(as_column(url), "http://", "https://")
    slash, query = F.instr(bare, "/"), F.instr(bare, "?")
    start = F.when(slash > 0, slash + 1).when(query > 0, query).otherwise(F.lit(1))
    return _before(F.substring(bare, start, F.length(bare)), "?")


def get_url_parameter(url: ColumnLike, parameter: str) -> Column:
    """Text after the first ``parameter=`` up to ``&``; empty or absent is null."""
    after = F.split_part(as_column(url), F.lit(f"{parameter}="), F.lit(2))
    return F.nullif(_before(after, "&"), F.lit(""))


# --- keys and patterns -------------------------------------------------------


def generate_surrogate_key(columns: Sequence[ColumnLike], null_token: str = NULL_TOKEN) -> Column:
    """MD5 over the columns' text; null and the empty string give different keys."""
    if not columns:
        raise ValueError("generate_surrogate_key needs at least one column")
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(null_token)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def with_flags(pattern: str, flags: str = "") -> str:
    """Pattern with inline flags; only the usual single-letter ones are accepted."""
    unknown = set(flags) - set("imsx")
    if unknown:
        raise ValueError(f"unknown regex flags: {''.join(sorted(unknown))}")
    return f"(?{flags}){pattern}" if flags else pattern


def regexp_instr(
    source: ColumnLike, pattern: str, position: int = 1, occurrence: int = 1, flags: str = ""
) -> Column:
    """1-based position of the given occurrence of a match, 0 if there is none."""
    if position < 1 or occurrence < 1:
        raise ValueError("position and occurrence count from 1")
    source, regex = as_column(source), F.lit(with_flags(pattern, flags))
    start = F.lit(position)
    for _ in range(occurrence):
        rest = F.substring(source, start, F.length(source))
        at = F.regexp_instr(rest, regex)
        found = F.when(at > 0, start + at - 1)
        width = F.length(F.regexp_substr(rest, regex))
        start = found + F.greatest(width, F.lit(1))
    return F.when(source.isNotNull(), F.coalesce(found, F.lit(0)))
