"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators count on. All can be changed by the caller
# afterwards; none fixes a partition count, which adaptive execution chooses.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more exchange above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables, from ``spark.checkpoint.dir``.

    Executors on other machines must be able to read it, so a temporary folder
    is made up only for a local master.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    chosen = spark.sparkContext._jsc.sc().getCheckpointDir()
    if chosen.isDefined():
        return chosen.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_written: dict[str, list[str]] = {}  # application id -> folders it wrote
_tables: dict[str, list[str]] = {}  # application id -> scratch tables it named
SCRATCH_DATABASE = "ledgerloom_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_table(spark: SparkSession, label: str) -> str:
    """A fresh table name in a database whose files lie in the shared scratch folder."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH_DATABASE} LOCATION '{scratch_dir(spark)}/{SCRATCH_DATABASE}'")
    name = f"{SCRATCH_DATABASE}.{label}_{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    return name


def drop_scratch(spark: SparkSession) -> int:
    """Delete the intermediate files and tables of this application; call it once its results are saved."""
    application = spark.sparkContext.applicationId
    for name in _tables.pop(application, []):
        database, prefix = name.split(".")
        for found in spark.sql(f"SHOW TABLES IN {database} LIKE '{prefix}*'").collect():
            kind = spark.catalog.getTable(f"{database}.{found['tableName']}").tableType
            spark.sql(f"DROP {'VIEW' if kind == 'VIEW' else 'TABLE'} IF EXISTS {database}.{found['tableName']}")
    paths = _written.pop(application, [])
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)


def materialise(df: DataFrame, label: str = "stage", partition_by: Sequence[str] = ()) -> DataFrame:
    """Evaluate once into the scratch folder and continue from the written table.

    The lineage ends there: a lost executor re-reads files and never
    re-evaluates a plan that depends on sampled range bounds.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime SQL setting for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
