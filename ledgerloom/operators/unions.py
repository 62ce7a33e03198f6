"""Union of tables whose columns differ."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

# Fixed value: default name of the column that says where a row came from.
SOURCE_COLUMN = "_dbt_source_relation"


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = SOURCE_COLUMN,
    where: str | None = None,
) -> DataFrame:
    """Union all of named tables over the superset of their columns.

    Columns keep the order in which they are first seen and the name and type they
    first have, unless overridden; names that differ in case only are one column. A
    table lacking a column contributes NULLs.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = column_override or {}
    included, excluded = {c.lower() for c in include}, {c.lower() for c in exclude}

    def wanted(name: str) -> bool:
        return name.lower() not in excluded and (not included or name.lower() in included)

    types: dict[str, T.DataType | str] = {}
    names: dict[str, str] = {}  # lower case -> name first seen
    for df in relations.values():
        for field in df.schema.fields:
            if wanted(field.name):
                types.setdefault(names.setdefault(field.name.lower(), field.name), field.dataType)
    if not types:
        raise ValueError(f"no column to union in {', '.join(relations)}")
    types.update({names[name.lower()]: kind for name, kind in override.items() if name.lower() in names})

    def aligned(name: str, df: DataFrame) -> DataFrame:
        rows = df.filter(where) if where else df
        source = [F.lit(name).alias(source_column_name)] if source_column_name else []
        own = {c.lower(): c for c in df.columns}
        cells = [(F.col(f"`{own[c.lower()]}`") if c.lower() in own else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        return rows.select(*source, *cells)

    return reduce(DataFrame.unionAll, [aligned(name, df) for name, df in relations.items()])
