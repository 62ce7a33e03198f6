"""Pivot, unpivot and first-row-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions.casts import column
from ..functions.expressions import slugify
from .projection import filtered_columns

COMPARE = {
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<>": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
}
AGGREGATE = {"sum": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max}


def pivot_columns(
    name: str,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: Column | str | int = 1,
    else_value: Column | str | int | None = 0,
    slug: bool = False,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, for a single ``groupBy(...).agg``.

    ``then_value`` and ``else_value`` take a number, a column or a column name;
    ``slug`` turns the values into plain identifiers.
    """
    if cmp not in COMPARE or agg not in AGGREGATE:
        raise ValueError(f"unsupported comparison {cmp!r} or aggregate {agg!r}")
    as_column = lambda v: F.col(v) if isinstance(v, str) else v if isinstance(v, Column) else F.lit(v)
    columns = []
    for value in values:
        cell = F.when(COMPARE[cmp](column(name), F.lit(value)), as_column(then_value)).otherwise(as_column(else_value))
        if distinct:
            total = {"sum": F.sum_distinct, "count": F.count_distinct}.get(agg, AGGREGATE[agg])(cell)
        else:
            total = AGGREGATE[agg](cell)
        label = f"{prefix}{value}{suffix}"
        columns.append(total.alias(slugify(label) if slug else label))
    return columns


def pivot(df: DataFrame, group: Sequence[str], name: str, values: Sequence, **options) -> DataFrame:
    return df.groupBy(*group).agg(*pivot_columns(name, values, **options))


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to rows in one pass; ``exclude`` columns stay, ``remove`` ones go."""
    measures = filtered_columns(df, [*exclude, *remove])
    if not measures:
        raise ValueError("no column left to unpivot")

    def as_value(name: str) -> Column:
        return F.col(f"`{name}`").cast(cast_to).alias(name)

    kept = [c for c in df.columns if c.lower() in {e.lower() for e in exclude}]
    typed = df.select(*[F.col(f"`{c}`") for c in kept], *[as_value(c) for c in measures])
    return typed.unpivot([F.col(f"`{c}`") for c in kept], [F.col(f"`{c}`") for c in measures], field_name, value_name)


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[tuple[str, str]]) -> DataFrame:
    """First row of each key, ``order_by`` given as (column, 'asc' or 'desc').

    An aggregate rather than a window: each task keeps one candidate row per
    key before the shuffle, so a key with many copies costs one row per task.
    NULLs come first ascending and last descending, as in a Spark sort.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]
    best = F.struct(*columns)
    # all ascending or all descending sorts compare as one struct
    directions = {d.lower() for _, d in order_by}
    if not directions <= {"asc", "desc"}:
        raise ValueError(f"order must be 'asc' or 'desc', got {order_by}")
    order = F.struct(*[F.col(f"`{c}`") for c, _ in order_by])
    if directions == {"desc"}:
        picked = F.max_by(best, order)
    elif directions == {"asc"}:
        picked = F.min_by(best, order)
    else:
        # mixed directions: reverse what is descending
        types = {f.name: f.dataType for f in df.schema.fields}
        parts = []
        for name, direction in order_by:
            c = F.col(f"`{name}`")
            if direction.lower() == "desc":
                kind = types[name]
                if isinstance(kind, (T.FloatType, T.DoubleType)):
                    # NaN is the largest value
                    parts += [c.isNull(), ~F.isnan(c), -F.nanvl(c, F.lit(0.0))]
                elif isinstance(kind, T.DecimalType):
                    parts += [c.isNull(), -c]
                elif isinstance(kind, (T.StringType, T.BinaryType)):
                    # complement of the bytes; the end mark puts a longer text before its own beginning
                    parts += [c.isNull(), F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))]
                else:
                    if isinstance(kind, T.DateType):
                        c = F.datediff(c, F.lit("1970-01-01").cast("date"))
                    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
                        c = F.unix_micros(c.cast("timestamp"))
                    elif isinstance(kind, T.BooleanType):
                        c = c.cast("int")
                    elif not isinstance(kind, T.IntegralType):
                        raise ValueError(f"cannot mix directions on {name}: {kind.simpleString()}")
                    parts += [c.isNull(), F.bitwise_not(c)]  # reverses the order and, unlike minus, has no overflow
            else:
                parts.append(c)
        picked = F.min_by(best, F.struct(*parts))
    return df.groupBy(*[F.col(f"`{k}`") for k in partition_by]).agg(picked.alias("_row")).select("_row.*")
