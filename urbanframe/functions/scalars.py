"""Scalar column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def half_even(x: Column, places: int = 0) -> Column:
    """Round to ``places`` decimals, halves to the even digit."""
    return F.bround(x, places)


def to_int_half_even(x: Column) -> Column:
    """Nearest integer, halves to even (a plain cast would truncate)."""
    return F.rint(x).cast("int")


def seconds_of(clock: Column) -> Column:
    """Seconds of ``HH:MM:SS``; hours may pass 24; anything else is null."""
    part = F.split(clock, ":")
    number = lambda i: F.try_element_at(part, F.lit(i)).try_cast("bigint")
    return number(1) * 3600 + number(2) * 60 + number(3)


def hours_of(clock: Column) -> Column:
    """Hours of ``HH:MM:SS`` as a double."""
    return seconds_of(clock) / 3600.0


def clock_of(seconds: Column) -> Column:
    """``HH:MM:SS`` of seconds, hours beyond 24 kept."""
    s = seconds.cast("bigint")
    # Few mentions of ``s``: where it is a long column itself, each is code of that length.
    h, two = F.floor(s / 3600), lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.concat(F.when(h < 10, F.lit("0")).otherwise(F.lit("")), h.cast("string"), F.lit(":"), two(F.floor(s / 60) % 60), F.lit(":"), two(s % 60))


def overlap_hours(start: Column, end: Column, window_start: str, window_end: str) -> Column:
    """Hours of ``[start, end]`` inside a window, never negative, to one decimal."""
    at_least_zero = lambda x: F.greatest(F.lit(0.0), x)
    low, high = hours_of(F.lit(window_start)), hours_of(F.lit(window_end))
    s, e = hours_of(start), hours_of(end)
    return half_even(at_least_zero(at_least_zero(e - s) - at_least_zero(low - s) - at_least_zero(e - high)), 1)


def minutes_between(start: str, end: str) -> float:
    """Length of a clock window in minutes."""
    def seconds(clock: str) -> int:
        h, m, s = map(int, clock.split(":"))
        return 3600 * h + 60 * m + s

    return (seconds(end) - seconds(start)) / 60


def clamp(x: Column, low: float, high: float) -> Column:
    """``x`` held between two bounds; null stays null."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def recode(x: Column, codes: dict[str, str]) -> Column:
    """Mapped value where there is one, else the value itself."""
    pairs = F.create_map(*[F.lit(v) for kv in codes.items() for v in kv])
    return F.coalesce(F.try_element_at(pairs, x), x)


def resolution_metres(text: Column) -> Column:
    """``'100m'`` -> 100.0; what is no positive number of metres is null."""
    number = F.regexp_extract(F.trim(text), r"^([0-9]+(?:\.[0-9]+)?) ?m$", 1).try_cast("double")
    return F.when(number > 0, number)


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9.0 / 5.0 + 32.0


def bits_clear(flags: Column, mask: int) -> Column:
    """True where none of the mask's bits is set."""
    return flags.bitwiseAND(F.lit(mask)) == 0


def row_sum(*columns: Column) -> Column:
    """Sum of a row's values, nulls skipped; all null gives 0."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.coalesce(c.cast("double"), F.lit(0.0))
    return total


def row_mean(*columns: Column) -> Column:
    """Mean of a row's values, nulls skipped; all null gives null."""
    count = sum((c.isNotNull().cast("int") for c in columns), F.lit(0))
    return F.try_divide(row_sum(*columns), count.cast("double"))


def tag_json(*columns: str) -> Column:
    """JSON object of a row's non-null tags."""
    return F.to_json(F.struct(*columns))


# Tag keys that may identify somebody, beside those with "name".
IDENTIFYING_KEYS = ("addr:city", "addr:full", "addr:place", "addr:postcode", "addr:province", "addr:street", "website", "wikipedia", "description", "addr:housenumber", "addr:interpolation", "designation", "email", "phone", "ref:capad2014_osm", "nswlpi:cadid", "wikidata", "url")


def without_keys(tags: Column, exact: list[str] | tuple[str, ...] = IDENTIFYING_KEYS, part: str = "name") -> Column:
    """Tag map without keys that contain ``part`` (any case) or are listed."""
    return F.map_filter(tags, lambda k, _: ~F.lower(k).contains(part) & ~k.isin(list(exact)))
