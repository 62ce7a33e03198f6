"""Table equality by checksums: rows cross the cluster only where the tables differ.

Rows are dealt to buckets by a hash of all compared columns. The count and the sum of the hashes of a bucket do not
depend on the order of its rows, so both tables are read once and a few hundred sums compared. Buckets that differ are
cut into smaller ones the same way, and only the rows of small buckets that differ still are compared as rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..operators.ordered import fitting
from ..session import materialise
from . import tables

BUCKET_BITS = 8  # of a level
LEVELS = 2
PART_BITS = 24  # sums over parts of so many bits stay in a long up to 2**39 rows of one bucket

#: types whose hash is the same for values that compare as equal
HASHED = (T.BooleanType, T.IntegralType, T.FractionalType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _hashable(kind: T.DataType) -> bool:
    # other collations and nested values have equal values of different hashes
    return kind == T.StringType() or isinstance(kind, HASHED)


def _row_hash(cols: Sequence[str], salt: int) -> Column:
    # a NULL leaves the hash as it is, so which columns are NULL is hashed too
    return F.xxhash64(F.lit(salt), *[F.isnull(F.col(f"`{c}`")) for c in cols], *[F.col(f"`{c}`") for c in cols])


def _parts(h: Column) -> list[Column]:
    return [F.shiftrightunsigned(h, first).bitwiseAND((1 << PART_BITS) - 1) for first in range(0, 64, PART_BITS)]


def _bucket(level: int) -> Column:
    return F.col("_h1").bitwiseAND((1 << BUCKET_BITS * level) - 1)


def _hashed(df: DataFrame) -> DataFrame:
    return df.select("*", _row_hash(df.columns, 1).alias("_h1"))


def differing_buckets(a: DataFrame, b: DataFrame, level: int) -> DataFrame:
    """``bucket`` of the rows (with ``_h1``) in which the tables do not hold the same rows equally often."""
    cols = [c for c in a.columns if c != "_h1"]
    parts = [F.lit(1).cast("bigint"), *_parts(F.col("_h1")), *_parts(_row_hash(cols, 2))]
    signed = lambda df, sign: df.select(_bucket(level).alias("bucket"), *[(p * sign).alias(f"_p{i}") for i, p in enumerate(parts)])
    sums = signed(a, 1).unionAll(signed(b, -1)).groupBy("bucket").agg(*[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(len(parts))])
    return sums.filter(" OR ".join(f"_p{i} <> 0" for i in range(len(parts)))).select("bucket")


def differing_rows(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables that lie in differing buckets; every row that is not equally often in both is among them.

    Columns are paired by position, as in set operations. Equal tables cost one scan each, different ones a scan more
    and the exchange of the rows returned. The tables are read again at every level and must give the same rows.
    Columns of nested types or other collations are not hashed: then all rows are returned.
    """
    common = a.limit(0).unionAll(b.limit(0)).schema
    if not all(_hashable(f.dataType) for f in common.fields):
        return a, b
    names = [f"_c{i}" for i in range(len(common.fields))]
    alike = lambda df: df.toDF(*names).select(*[F.col(n).cast(f.dataType).alias(n) for n, f in zip(names, common.fields)])
    left, right = _hashed(alike(a)), _hashed(alike(b))
    for level in range(1, LEVELS + 1):
        found = materialise(differing_buckets(left, right, level), "buckets")
        many = found.count()
        if many == 0:
            return a.limit(0), b.limit(0)
        near = fitting(found, many)
        left, right = (df.join(near, _bucket(level) == F.col("bucket"), "left_semi") for df in (left, right))
    return left.drop("_h1").toDF(*a.columns), right.drop("_h1").toDF(*a.columns)


def differing_forms(forms: Sequence[DataFrame]) -> tuple[list[int] | None, list[DataFrame]]:
    """Rows of each of several tables, and of each the rows in buckets in which not all hold the same rows equally often.

    As ``differing_rows``, with one pass over all tables a level; where nothing differs no row is exchanged. Columns of
    nested types or other collations are not hashed: then all rows are returned, uncounted.
    """
    common = reduce(DataFrame.unionAll, [f.limit(0) for f in forms]).schema
    if not all(_hashable(f.dataType) for f in common.fields):
        return None, list(forms)
    names = [f"_c{i}" for i in range(len(common.fields))]
    held = [_hashed(df.toDF(*names).select(*[F.col(n).cast(f.dataType).alias(n) for n, f in zip(names, common.fields)])) for df in forms]
    parts = [F.lit(1).cast("bigint"), *_parts(F.col("_h1")), *_parts(_row_hash(names, 2))]
    counts: list[int] = []
    for level in range(1, LEVELS + 1):
        columns = [p.alias(f"_p{i}") for i, p in enumerate(parts)]
        each = reduce(DataFrame.unionAll, [df.select(F.lit(k).alias("form"), _bucket(level).alias("bucket"), *columns) for k, df in enumerate(held)])
        sums = materialise(each.groupBy("form", "bucket").agg(*[F.sum(f"_p{i}").alias(f"_p{i}") for i in range(len(parts))]), "sums")
        if not counts:
            of_form = dict(sums.groupBy("form").agg(F.sum("_p0")).collect())
            counts = [of_form.get(k, 0) for k in range(len(forms))]
        unlike = reduce(Column.__or__, [F.min(f"_p{i}") != F.max(f"_p{i}") for i in range(len(parts))])
        found = sums.groupBy("bucket").agg((unlike | (F.count(F.lit(1)) < len(forms))).alias("unlike")).filter("unlike").select("bucket")
        found = materialise(found, "buckets")
        many = found.count()
        if many == 0:
            return counts, [df.limit(0) for df in forms]
        near = fitting(found, many)
        held = [df.join(near, _bucket(level) == F.col("bucket"), "left_semi") for df in held]
    return counts, [df.drop("_h1").toDF(*f.columns) for df, f in zip(held, forms)]


def equality(df: DataFrame, compare: DataFrame, compare_columns: Sequence[str] | None = None, exact: bool = False) -> DataFrame:
    """``tables.equality`` for tables that are mostly the same."""
    cols = list(compare_columns or df.columns)
    return tables.equality(*differing_rows(df.select(*cols), compare.select(*cols)), cols, exact)


def cardinality_equality(df: DataFrame, c: str, to: DataFrame, field: str) -> DataFrame:
    """``tables.cardinality_equality`` for columns that mostly hold the same values: all rows of a value share a bucket."""
    a, b = differing_rows(df.select(c), to.select(F.col(field).alias(c)))
    return tables.cardinality_equality(a, c, b, c)
