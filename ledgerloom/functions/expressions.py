"""Scalar expressions shared by the operators and plans; all stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from .casts import column

# Fixed value: stands for NULL inside surrogate keys, so it decides their hashes.
NULL_KEY_TOKEN = "_dbt_utils_surrogate_key_null_"

# Earth radius in miles and kilometres per mile.
EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def banded(c: Column | str, floors: Sequence[tuple[float, str]], otherwise: str, strict: bool = False) -> Column:
    """Label of the first floor that ``c`` reaches (or exceeds, when strict)."""
    value = column(c)
    ladder = F
    for floor, label in floors:
        ladder = ladder.when(value > floor if strict else value >= floor, F.lit(label))
    return ladder.otherwise(F.lit(otherwise))


def ladder(arms: Sequence[tuple[Column, str | int]], otherwise: str | int) -> Column:
    """First arm whose condition is true."""
    case = F
    for condition, label in arms:
        case = case.when(condition, F.lit(label))
    return case.otherwise(F.lit(otherwise))


def mask_pii(c: Column | str, min_hidden: int = 0) -> Column:
    """First three and last four characters around eight stars.

    Short values stay readable by default; ``min_hidden`` stars out any value
    that would hide fewer characters than that.
    """
    value = column(c)
    masked = F.concat(F.left(value, F.lit(3)), F.lit("********"), F.right(value, F.lit(4)))
    if min_hidden:
        masked = F.when(F.length(value) < 7 + min_hidden, F.lit("********")).otherwise(masked)
    return F.when(value.isNotNull(), masked)


def hash_column(c: Column | str, algorithm: str = "sha256") -> Column:
    text = column(c).cast("string")
    if algorithm == "md5":
        return F.md5(text)
    bits = {"sha224": 224, "sha256": 256, "sha384": 384, "sha512": 512}
    if algorithm not in bits:
        raise ValueError(f"unknown hash algorithm {algorithm!r}")
    return F.sha2(text, bits[algorithm])


def surrogate_key(cols: Sequence[Column | str], null_as_empty: bool = False) -> Column:
    """md5 over the columns as text, joined by '-'."""
    absent = F.lit("" if null_as_empty else NULL_KEY_TOKEN)
    return F.md5(F.concat_ws("-", *[F.coalesce(column(c).cast("string"), absent) for c in cols]))


def business_key(cols: Sequence[Column | str]) -> Column:
    """Columns joined by '~'; NULL as soon as one of them is NULL."""
    parts: list[Column] = []
    for c in cols:
        parts += [F.lit("~"), column(c).cast("string")]
    return F.concat(*parts[1:])


def safe_add(cols: Sequence[Column | str]) -> Column:
    if not cols:
        raise ValueError("safe_add needs at least one column")
    return reduce(lambda a, b: a + b, [F.coalesce(column(c), F.lit(0)) for c in cols])


def safe_subtract(cols: Sequence[Column | str]) -> Column:
    if not cols:
        raise ValueError("safe_subtract needs at least one column")
    return reduce(lambda a, b: a - b, [F.coalesce(column(c), F.lit(0)) for c in cols])


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    return F.try_divide(column(numerator), column(denominator))


def width_bucket(c: Column | str, low, high, buckets) -> Column:
    """Bucket 1..n inside [low, high), 0 below, n+1 at or above ``high``."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.width_bucket(
        column(c).cast("double"), as_column(low).cast("double"), as_column(high).cast("double"), as_column(buckets).cast("int")
    )


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    if unit not in ("mi", "km"):
        raise ValueError(f"unit must be 'mi' or 'km', got {unit!r}")
    lat1, lon1, lat2, lon2 = (column(c) for c in (lat1, lon1, lat2, lon2))
    half_chord = lambda a, b: F.pow(F.sin(F.radians((b - a) / 2)), F.lit(2))
    a = half_chord(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_chord(lon1, lon2)
    # rounding can push opposite points a hair above 1, where asin is undefined
    miles = F.asin(F.sqrt(F.least(a, F.lit(1.0)))) * (2 * EARTH_RADIUS_MILES)
    return miles * KM_PER_MILE if unit == "km" else miles


def _without(text: Column, prefixes: Sequence[str]) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p), F.lit("")), prefixes, text)


def url_host(c: Column | str) -> Column:
    bare = _without(column(c), ["android-app://", "http://", "https://"])
    return F.split_part(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(c: Column | str) -> Column:
    """Text between the first slash and the query; a URL with neither is returned whole."""
    bare = _without(column(c), ["http://", "https://"])
    start = F.coalesce(F.nullif(F.instr(bare, "/"), F.lit(0)), F.instr(bare, "?") - 1)
    return F.split_part(F.right(bare, F.length(bare) - start), F.lit("?"), F.lit(1))


def url_parameter(c: Column | str, name: str) -> Column:
    """Text after the first ``name=``; NULL where absent or empty."""
    after = F.split_part(column(c), F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(after, F.lit("&"), F.lit(1)), F.lit(""))


def slugify(name: str) -> str:
    """A column name of lower-case letters, digits and underscores."""
    slug = re.sub(r"[^a-z0-9_]+", "", re.sub(r"[ -]+", "_", name.lower()))
    return f"_{slug}" if slug[:1].isdigit() else slug
