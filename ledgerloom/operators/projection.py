"""Column selection over a whole table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.group import GroupedData

from ..functions.expressions import hash_column, mask_pii


def filtered_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Column names without the excluded ones, whatever their case."""
    dropped = {name.lower() for name in exclude}
    return [name for name in df.columns if name.lower() not in dropped]


def star(df: DataFrame, exclude: Iterable[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, exclude)])


def staging_columns(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """``star`` whose exclusion list is case-sensitive."""
    dropped = set(exclude)
    return df.select([F.col(f"`{c}`") for c in df.columns if c not in dropped])


def nullcheck(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Empty strings become NULL, in the given columns or in all string columns."""
    wanted = None if cols is None else {c.lower() for c in cols}

    def clean(field: T.StructField):
        c = F.col(f"`{field.name}`")
        chosen = wanted is None or field.name.lower() in wanted
        if chosen and isinstance(field.dataType, T.StringType):
            return F.nullif(c, F.lit("")).alias(field.name)
        return c

    return df.select([clean(field) for field in df.schema.fields])


def group_by_first(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns of the table."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns[:n]])


def mask_columns(df: DataFrame, cols: Sequence[str], keep_raw: bool = False, min_hidden: int = 0) -> DataFrame:
    """Masked and hashed forms of personal columns in one projection.

    The hash stays joinable across tables; raw values go unless asked for.
    """
    hidden = {c.lower() for c in cols}
    kept = [F.col(f"`{c}`") for c in df.columns if keep_raw or c.lower() not in hidden]
    masked = [mask_pii(c, min_hidden).alias(f"{c}_masked") for c in cols]
    hashed = [hash_column(c).alias(f"{c}_hash") for c in cols]
    return df.select(*kept, *masked, *hashed)
