"""Scalar helpers: null-safe arithmetic, buckets, distance, keys, URLs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934
# Fixed value: text that stands for NULL in surrogate keys.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_add(*columns: str | Column) -> Column:
    """Sum with NULL as 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(_col(c), F.lit(0)) for c in columns])


def safe_subtract(*columns: str | Column) -> Column:
    """First minus all others, NULL as 0."""
    return reduce(lambda a, b: a - b, [F.coalesce(_col(c), F.lit(0)) for c in columns])


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """Quotient, NULL where the denominator is 0 or NULL."""
    return F.try_divide(_col(numerator), _col(denominator))


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)


def fixed_point(value: Column, digits: int) -> Column:
    """Text with ``digits`` decimals (at most 3), rounded by the exact binary value.

    43.65 is stored a little below, so it reads 43.6; ``format_string`` rounds the
    decimal text instead. The fraction is taken in units of 2^-52 as an integer.
    """
    scale, unit = 10**digits, 2**52
    size = F.abs(value)
    whole = F.floor(size).cast("bigint")
    exact = (size - whole) * F.lit(float(unit))
    bits = F.floor(exact).cast("bigint")
    steps = bits * F.lit(scale)
    rest = F.pmod(steps, F.lit(unit))
    low = F.shiftright(steps, 52)
    # how far the remainder is over one half; what floor cut off counts too
    over = (rest - F.lit(unit // 2)).cast("double") + (exact - bits) * scale
    up = (over > 0) | ((over == 0) & (F.pmod(low, F.lit(2)) == 1))
    ticks = low + F.when(up, 1).otherwise(0)
    sign = F.when((value < 0) & ((whole > 0) | (ticks > 0)), F.lit("-")).otherwise(F.lit(""))
    return F.format_string(
        f"%s%d.%0{digits}d", sign, whole + F.floor(ticks / scale).cast("bigint"), F.pmod(ticks, F.lit(scale))
    )


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    return F.try_divide(value - mean, deviation)


def bucket(value: str | Column, low, high, buckets: int | Column) -> Column:
    """Number of the equal-width half-open bucket; 0 below ``low``, n + 1 from ``high`` on."""
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    return F.width_bucket(
        _col(value).cast("double"), lit(low).cast("double"), lit(high).cast("double"), lit(buckets).cast("bigint")
    )


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, unit: str = "mi") -> Column:
    """Great-circle distance in miles or kilometres."""
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', not {unit!r}")
    half_chord = F.pow(F.sin(F.radians(lat2 - lat1) / 2), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), F.lit(2.0))
    miles = F.asin(F.sqrt(half_chord)) * (2 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles


def surrogate_key(*columns: str | Column, null_as_empty: bool = False) -> Column:
    """md5 of the columns as text, joined by '-'."""
    filler = F.lit("" if null_as_empty else NULL_KEY_TEXT)
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), filler) for c in columns]))


# Schemes that are cut off an address.
HOST_SCHEMES = ("android-app://", "http://", "https://")
PATH_SCHEMES = ("http://", "https://")


def _without(url: Column, schemes: tuple[str, ...]) -> Column:
    return reduce(lambda c, scheme: F.replace(c, F.lit(scheme), F.lit("")), schemes, url)


def _first(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def url_host(url: str | Column) -> Column:
    """Host of an address, without scheme, path and query."""
    return _first(_first(_without(_col(url), HOST_SCHEMES), "/"), "?")


def url_path(url: str | Column) -> Column:
    """What follows the first slash, up to the query.

    Without a slash it is what follows the character before the question mark;
    with neither, the address itself.
    """
    bare = _without(_col(url), PATH_SCHEMES)
    slash = F.instr(bare, "/")
    cut = F.when(slash > 0, slash).otherwise(F.instr(bare, "?") - 1)
    # a cut of -1 (neither mark) leaves the whole text
    return _first(F.when(cut < 0, bare).otherwise(F.substr(bare, cut + 1)), "?")


def url_parameter(url: str | Column, name: str) -> Column:
    """Value of a query parameter, NULL if absent or empty."""
    after = F.split_part(_col(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(_first(after, "&"), F.lit(""))


def null_if_empty(column: str | Column) -> Column:
    return F.nullif(_col(column), F.lit(""))
