"""The expressions and generators as functions of SQL text.

``register(spark)`` makes them temporary functions of the session. They are SQL functions: Catalyst puts their bodies
into the plan of the query, as the column functions of the same names do.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..operators.generators import PARTS, PERIODS_PER_BLOCK
from .expressions import EARTH_RADIUS_MILES, KM_PER_MILE, NULL_KEY_TOKEN

_HALF_CHORDS = (
    "pow(sin(radians((lat2 - lat1) / 2)), 2) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians((lon2 - lon1) / 2)), 2)"
)
_MILES = f"asin(sqrt(least({_HALF_CHORDS}, 1.0D))) * {2 * EARTH_RADIUS_MILES}D"
_POINTS = "lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE"
_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"

#: name -> parameters, type, body
SCALAR = {
    "safe_decimal": ("value STRING", "DECIMAL(15,2)", "try_cast(value AS DECIMAL(15,2))"),
    "safe_timestamp": ("value STRING", "TIMESTAMP", "try_cast(value AS TIMESTAMP)"),
    "age_years": ("born DATE, as_of TIMESTAMP", "BIGINT", "floor(datediff(as_of, born) / 365.25D)"),
    "mask_pii": ("value STRING", "STRING", "CASE WHEN value IS NOT NULL THEN concat(left(value, 3), '********', right(value, 4)) END"),
    "hash_column": ("value STRING", "STRING", "sha2(value, 256)"),
    "surrogate_key": ("parts ARRAY<STRING>", "STRING", f"md5(array_join(parts, '-', '{NULL_KEY_TOKEN}'))"),
    "business_key": ("parts ARRAY<STRING>", "STRING", "CASE WHEN NOT exists(parts, p -> p IS NULL) THEN array_join(parts, '~') END"),
    "safe_add": ("terms ARRAY<DOUBLE>", "DOUBLE", "aggregate(terms, 0D, (total, t) -> total + coalesce(t, 0D))"),
    "safe_divide": ("numerator DOUBLE, denominator DOUBLE", "DOUBLE", "try_divide(numerator, denominator)"),
    "haversine_miles": (_POINTS, "DOUBLE", _MILES),
    "haversine_km": (_POINTS, "DOUBLE", f"{_MILES} * {KM_PER_MILE}D"),
    "url_host": (
        "url STRING",
        "STRING",
        "split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1)",
    ),
    "url_path": (
        "url STRING",
        "STRING",
        f"split_part(right({_BARE}, length({_BARE}) - coalesce(nullif(instr({_BARE}, '/'), 0), instr({_BARE}, '?') - 1)), '?', 1)",
    ),
    "url_parameter": ("url STRING, name STRING", "STRING", "nullif(split_part(split_part(url, concat(name, '='), 2), '&', 1), '')"),
}

# two steps, so that no row holds more than a block of numbers
_NUMBERS = (
    f"SELECT explode(sequence(_block, _block + {PERIODS_PER_BLOCK - 1}L)) AS _i "
    f"FROM (SELECT explode(sequence(0L, greatest({{most}}, 0L), {PERIODS_PER_BLOCK}L)) AS _block)"
)


def _spine(part: str) -> tuple[str, str, str]:
    kind = "TIMESTAMP" if part in ("second", "minute", "hour") else "DATE"
    numbers = _NUMBERS.format(most=f"timestampdiff({part}, first, last)")
    at = f"timestampadd({part}, cast(_i AS INT), first)"
    return "first TIMESTAMP, last TIMESTAMP", f"date_{part} {kind}", f"SELECT cast({at} AS {kind}) FROM ({numbers}) WHERE {at} < last"


#: name -> parameters, columns, body
TABLE = {
    "generated_series": (
        "upper_bound BIGINT",
        "generated_number BIGINT",
        f"SELECT _i + 1 FROM ({_NUMBERS.format(most='upper_bound - 1')}) WHERE _i < upper_bound",
    ),
    **{f"date_spine_{part}": _spine(part) for part in PARTS},
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions in the session, replacing earlier ones; returns their names.

    Bounds of spines: from the first up to, not including, the last; an end before the start gives no row.
    ``surrogate_key`` and ``business_key`` take an array of texts, ``safe_add`` an array of numbers.
    """
    for name, (parameters, kind, body) in SCALAR.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")
    for name, (parameters, columns, body) in TABLE.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) RETURN {body}")
    return [*SCALAR, *TABLE]
