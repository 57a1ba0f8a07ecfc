"""Catalog tables: namespace, full refresh and append."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.session import shared_folder

# Table property: where the version before the current one is.
PREVIOUS = "cohortlens.previous_version"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
    buckets: tuple[int, str] | None = None,
) -> int:
    """Writes a catalog table and returns the number of rows written.

    The count is observed by the write itself, in its last stage, where Spark
    counts each finished task once. The table is not scanned again.

    ``buckets`` (number, key) exchanges the rows once here, one task per bucket,
    so that later joins on the key need no exchange.

    An overwrite is atomic: it writes a version of its own beside the table and points the
    table to it once it is complete. If it fails, the table is what it was; who reads the
    version before goes on reading it, since it is kept until the overwrite after the next.
    A format that replaces its tables itself (``delta``) does so.
    """
    seen = Observation()
    if buckets:
        df = df.repartition(*buckets)
    writer = df.observe(seen, F.count("*").alias("n")).write.format(fmt).mode(mode).options(**dict(options or {}))
    if buckets:
        writer = writer.bucketBy(*buckets).sortBy(buckets[1])
    if mode != "overwrite" or fmt == "delta":
        writer.saveAsTable(name)
        return seen.get["n"]
    spark = df.sparkSession
    database, table = name.split(".") if "." in name else (spark.catalog.currentDatabase(), name)
    version = f"{table}__{uuid.uuid4().hex}"
    path = f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{version}"
    try:
        writer.option("path", path).saveAsTable(f"{database}.{version}")
        rows = seen.get["n"]
        _swap(spark, database, table, version, path)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {database}.{version}")
        delete_folder(spark, path)
        raise
    return rows


def _described(spark: SparkSession, name: str) -> dict[str, str]:
    """What tells whether two tables differ in more than their location, and that location."""
    wanted = ("Provider", "Num Buckets", "Bucket Columns", "Sort Columns", "Location")
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return {k: rows.get(k) for k in wanted}


def _swap(spark: SparkSession, database: str, table: str, version: str, path: str) -> None:
    """Points ``table`` to the complete version, one change in the catalog where the table's form stays."""
    name, new = f"{database}.{table}", f"{database}.{version}"
    if not spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
        return
    before, after = _described(spark, name), _described(spark, new)
    old = before.pop("Location")
    after.pop("Location")
    if before == after and spark.table(name).schema == spark.table(new).schema:
        stale = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}.get(PREVIOUS)
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{PREVIOUS}' = '{old}')")
        spark.sql(f"DROP TABLE {new}")  # the catalog's entry only: its files are the table's now
        if stale and stale != old:
            delete_folder(spark, stale)
    else:  # another schema, format or bucketing: a moment without the table, never without its rows
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {name}")
    spark.catalog.refreshTable(name)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever file system holds it; a missing one is no error."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a result that is used several times: its joins run once, later uses read
    only the columns they need, and a lost executor costs a re-read.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
