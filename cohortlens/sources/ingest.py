"""Incremental loading of a landing folder by its manifest.

A ledger lists every file that was loaded, with its size and time. A run loads the files that
the manifest has and the ledger has not, or has with another size or time. Rows and ledger
entries of a run go to folders named by the batch: a digest of its files, sizes and times.
A run that is repeated after a failure finds the same batch and writes it over; a batch
counts once its ledger entries are there. So no file is loaded twice or lost.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.sources.files import manifest, read_csv, stamp

LEDGER = "path string, length long, modified timestamp, state string, batch string"
NEW, CHANGED = "new", "changed"


@dataclass(frozen=True)
class Ingest:
    """Loads the CSV files below ``landing`` into ``store``, a folder all executors reach."""

    spark: SparkSession
    landing: str
    store: str
    schema: str
    source_system: str

    def _stored(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.store}/{name}/*")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        """Every load of every file: path, length, modified, state (new or changed), batch."""
        return self._stored("ledger", T.StructType.fromDDL(LEDGER))

    def _latest(self) -> DataFrame:
        newest = F.max_by(F.struct("length", "modified", "batch"), F.struct("modified", "batch")).alias("known")
        return self.ledger().groupBy("path").agg(newest)

    def pending(self) -> DataFrame:
        """Files to load: path, length, modified, state. An anti join of the manifest with the ledger."""
        files = manifest(self.spark, self.landing).where(F.col("path").endswith(".csv") & (F.col("length") > 0))
        found = files.withColumnRenamed("modificationTime", "modified").join(self._latest(), "path", "left")
        same = (F.col("known.length") == F.col("length")) & (F.col("known.modified") == F.col("modified"))
        state = F.when(F.col("known").isNull(), NEW).otherwise(CHANGED).alias("state")
        return found.where(F.col("known").isNull() | ~same).select("path", "length", "modified", state)

    def run(self) -> str | None:
        """Loads what is pending and returns the batch, or None if there was nothing.

        The list of files passes through the driver, which holds it anyway to plan the scan.
        """
        files = sorted(self.pending().collect())
        if not files:
            return None
        batch = hashlib.sha256(repr([tuple(f)[:3] for f in files]).encode()).hexdigest()[:32]
        rows = read_csv(self.spark, [f["path"] for f in files], self.schema)
        stamped = stamp(rows, self.source_system).withColumns(
            {"source_file": F.input_file_name(), "batch": F.lit(batch)}
        )
        stamped.write.mode("overwrite").parquet(f"{self.store}/rows/batch-{batch}")
        entries = self.spark.createDataFrame([(*f, batch) for f in files], LEDGER)
        entries.coalesce(1).write.mode("overwrite").parquet(f"{self.store}/ledger/batch-{batch}")
        return batch

    def loads(self) -> DataFrame:
        """The rows of all committed batches, also those of files that were loaded again later."""
        schema = T.StructType(
            [
                *T.StructType.fromDDL(self.schema),
                *T.StructType.fromDDL("created_timestamp timestamp, source_system string, source_file string, batch string"),
            ]
        )
        committed = self.ledger().select("batch").distinct()
        return self._stored("rows", schema).join(committed, "batch", "left_semi")

    def current(self) -> DataFrame:
        """The rows of every file as it was loaded last."""
        last = self._latest().select(_plain("path").alias("_path"), F.col("known.batch").alias("_batch"))
        rows = self.loads()
        of = (_plain("source_file") == F.col("_path")) & (F.col("batch") == F.col("_batch"))
        return rows.join(last, of, "left_semi")


def _plain(path: str):
    """A file's path without its scheme's slashes, which the manifest and the scan write differently."""
    return F.url_decode(F.regexp_replace(path, "^([a-z0-9]+):/+", "$1:/"))
