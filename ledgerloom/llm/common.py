"""Small helpers shared by the operators: whole rows under one name, and the digest of a query."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import tune

#: stands for a missing doc_id where an order is needed: the smallest long
NO_ID = -(2**63)


#: rows and bytes handed to a Python worker at a time; texts are long, and an executor has several workers
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}

_shipped: set[str] = set()  # applications that have the package


def prepare(spark: SparkSession) -> SparkSession:
    """Sets what the operators count on, and sends this package to the Python workers of the application."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for module in sorted(package.rglob("*.py")):
                out.write(module, module.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped.add(application)
    for key, value in ARROW.items():
        spark.conf.set(key, value)
    return tune(spark)


def as_row(df: DataFrame) -> Column:
    """All columns of ``df`` in one struct, so that no added column can clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def id_key(df: DataFrame, name: str = "doc_id") -> Column:
    """An id as a long; a missing one counts as the smallest."""
    return F.coalesce(df[name].cast("long"), F.lit(NO_ID))


def whole_text(df: DataFrame, name: str = "text") -> Column:
    return F.coalesce(df[name].cast("string"), F.lit(""))


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_text(row: Column, columns: list[str], text: Column) -> list[Column]:
    """The columns of ``row`` with another text, and n_chars to match where there is one."""
    new = {"text": text.alias("text"), "n_chars": F.length(text).cast("long").alias("n_chars")}
    return [new.get(c, row.getField(c).alias(c)) for c in columns]
