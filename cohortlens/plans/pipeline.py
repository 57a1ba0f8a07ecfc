"""The batch run: landing files to bronze, silver, gold, predictions and alerts.

``run_pipeline`` is one plain call for any scheduler. Each layer writes its
tables, records one audit row per table and stops the run if a table failed.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import replace
from functools import reduce
from types import MappingProxyType

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.config import PipelineConfig
from cohortlens.operators import alerts, joins, model, quality
from cohortlens.plans import gold, silver
from cohortlens.schemas import RAW_FILES
from cohortlens.sources import audit
from cohortlens.sources.files import checked_csv, read_csv, stamp
from cohortlens.sources.tables import create_database, save_table

AUDIT_TABLE = "pipeline_audit_log"
MALFORMED = "_malformed_record"


class LayerFailed(RuntimeError):
    """A table of a layer could not be written; the audit log names it."""


class Pipeline:
    """One run's session and settings; each method is one step and can be called alone.

    ``run_id`` names the run in the audit log. A step called again under the same id is a
    retry: its tables are replaced, and its audit rows take the place of the former ones.
    """

    def __init__(self, spark: SparkSession, cfg: PipelineConfig = PipelineConfig(), run_id: str | None = None):
        self.spark = spark
        self.cfg = cfg
        self.run_id = run_id or uuid.uuid4().hex

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self.cfg.table(name))

    def _save(self, df: DataFrame, name: str, buckets: tuple[int, str] | None = None) -> int:
        return save_table(
            df, self.cfg.table(name), fmt=self.cfg.table_format, options=self.cfg.write_options, buckets=buckets
        )

    def write_layer(
        self,
        layer: str,
        tables: Mapping[str, Callable[[], DataFrame]],
        buckets: Mapping[str, tuple[int, str]] = MappingProxyType({}),
        needs: Mapping[str, Iterable[str]] = MappingProxyType({}),
        notes: Callable[[str], str | None] = lambda name: None,
    ) -> dict[str, int]:
        """Writes the tables in order and audits each, a failed plan or write included.

        ``needs`` names the tables of the layer that a table is read from: if one of
        them failed, the table is not run on what an earlier run left, but failed too.
        ``notes`` gives the message for a table that was written.
        """
        rows, first_error = [], None
        for name, build in tables.items():
            if lost := [r.table_name for r in rows if r.run_status == audit.FAILED and r.table_name in needs.get(name, ())]:
                message = f"not run: {', '.join(lost)} failed"
                rows.append(audit.AuditRow(self.cfg.pipeline_name, layer, name, None, audit.FAILED, message))
                continue
            row, error = audit.audited(
                self.cfg.pipeline_name, layer, name, lambda b=build, n=name: self._save(b(), n, buckets.get(n))
            )
            rows.append(replace(row, error_message=notes(name)) if error is None else row)
            first_error = first_error or error
        audit.write_audit_log(self.spark, self.cfg.table(AUDIT_TABLE), rows, self.cfg.table_format, self.run_id)
        if first_error is not None:
            failed = [r.table_name for r in rows if r.run_status == audit.FAILED]
            raise LayerFailed(f"{layer}: {', '.join(failed)}") from first_error
        return {r.table_name: r.record_count for r in rows}

    def bronze(self, raw_dir: str) -> dict[str, int]:
        """Loads the five files; the audit row says how many records have a value of the wrong type.

        With ``on_malformed="quarantine"`` such records, and those with too few or too many
        fields, go to ``bronze_rejects`` instead, with file, columns and reason.
        """
        if self.cfg.on_malformed == "quarantine":
            return self._bronze_checked(raw_dir)
        seen = {r.bronze: Observation() for r in RAW_FILES.values()}

        def load(raw) -> DataFrame:
            path, options = f"{raw_dir.rstrip('/')}/{raw.csv}", dict(self.cfg.csv_options)
            if self.cfg.infer_schema:
                return stamp(read_csv(self.spark, path, infer=True, **options), self.cfg.source_system)
            source = read_csv(self.spark, path, raw.schema, **options, columnNameOfCorruptRecord=MALFORMED)
            counted = source.observe(seen[raw.bronze], F.count(MALFORMED).alias("n"))
            return stamp(counted.drop(MALFORMED), self.cfg.source_system)

        def malformed(name: str) -> str | None:
            n = 0 if self.cfg.infer_schema else seen[name].get["n"]
            return f"{n} malformed records" if n else None

        return self.write_layer("bronze", {r.bronze: lambda r=r: load(r) for r in RAW_FILES.values()}, notes=malformed)

    def _bronze_checked(self, raw_dir: str) -> dict[str, int]:
        @functools.cache
        def parts(name: str) -> tuple[DataFrame, DataFrame]:
            raw = next(r for r in RAW_FILES.values() if r.bronze == name)
            return checked_csv(self.spark, f"{raw_dir.rstrip('/')}/{raw.csv}", raw.schema, **self.cfg.csv_options)

        def rejects() -> DataFrame:
            named = [parts(r.bronze)[1].withColumn("table_name", F.lit(r.bronze)) for r in RAW_FILES.values()]
            return stamp(reduce(DataFrame.unionByName, named), self.cfg.source_system)

        tables = {r.bronze: lambda n=r.bronze: stamp(parts(n)[0], self.cfg.source_system) for r in RAW_FILES.values()}
        return self.write_layer("bronze", {**tables, "bronze_rejects": rejects})

    def silver(self) -> dict[str, int]:
        def clean(entity: str) -> DataFrame:
            return silver.TRANSFORMS[entity](self.read(RAW_FILES[entity].bronze), self.cfg.rules)

        buckets = {}
        if self.cfg.silver_buckets:
            hot = joins.hot_keys({e: clean(e) for e in RAW_FILES}, gold.KEY, self.cfg.hot_key_rows)
            most = hot.agg(*[F.max(e).alias(e) for e in RAW_FILES]).first()
            # One bucket is one task's write, so a table with a key that is hot in it has none.
            calm = [e for e in RAW_FILES if (most[e] or 0) <= self.cfg.hot_key_rows]
            buckets = {RAW_FILES[e].silver: (self.cfg.silver_buckets, gold.KEY) for e in calm}
        return self.write_layer("silver", {r.silver: lambda e=e: clean(e) for e, r in RAW_FILES.items()}, buckets)

    def silver_tables(self) -> dict[str, DataFrame]:
        return {entity: self.read(raw.silver) for entity, raw in RAW_FILES.items()}

    def require_unique_keys(self) -> None:
        for entity, df in self.silver_tables().items():
            quality.assert_unique_key(df, gold.KEY, RAW_FILES[entity].silver)

    def hot_keys(self, tables: Mapping[str, DataFrame]) -> DataFrame | None:
        """Keys to split in the joins, measured once for all gold tables; None if there are none."""
        found = joins.hot_keys(tables, gold.KEY, self.cfg.hot_key_rows)
        return None if found.isEmpty() else found

    def gold(self) -> dict[str, int]:
        if self.cfg.on_repeated_key == "fail":
            self.require_unique_keys()
        tables, rules = self.silver_tables(), self.cfg.rules
        hot = self.hot_keys(tables)
        return self.write_layer(
            "gold",
            {
                "gold_student_risk_profile": lambda: gold.student_risk_profile(tables, rules, hot),
                "gold_attendance_vs_performance": lambda: gold.attendance_vs_performance(tables, rules, hot),
                "gold_dropout_trends": lambda: gold.dropout_trends(tables, rules, hot),
                "gold_intervention_candidates": lambda: gold.intervention_candidates(
                    self.read("gold_student_risk_profile"), tables["retention"], hot
                ),
                "gold_retention_overview": lambda: gold.retention_overview(tables["retention"], rules),
            },
            needs={"gold_intervention_candidates": ["gold_student_risk_profile"]},
        )

    def predict(self) -> dict[str, int]:
        """Fits on the training part and stores scores and the test part's AUC."""
        cfg = self.cfg
        ready = model.features(self.read("gold_student_risk_profile"))
        train, test = model.split(ready, cfg.train_fraction, cfg.seed, cfg.split)
        chosen = {"test": test, "all": ready}[cfg.score_on]
        fitted = functools.cache(lambda: model.fit(model.assemble(train)))

        def predictions() -> DataFrame:
            return model.score(fitted(), chosen).select("student_id", "dropout_probability")

        def metrics() -> DataFrame:
            scored = model.score(fitted(), test)
            return model.auc_by_rank(scored).withColumn("run_timestamp", F.current_timestamp())

        return self.write_layer("ml", {"gold_dropout_predictions": predictions, "gold_model_metrics": metrics})

    def alert(self) -> dict[str, int]:
        rules = self.cfg.rules
        predictions = self.read("gold_dropout_predictions")
        return self.write_layer(
            "alerts",
            {
                "gold_high_risk_alerts": lambda: alerts.stamped(
                    alerts.high_risk(predictions, rules.alert_probability)
                ),
                "gold_alert_digest": lambda: alerts.digest(
                    self.read("gold_high_risk_alerts"), self.read("gold_student_risk_profile"), rules.alert_top_k
                ),
                "gold_institution_trend": lambda: alerts.institution_trend(
                    self.read(RAW_FILES["students"].silver),
                    self.read(RAW_FILES["retention"].silver),
                    rules.trend_min_increase,
                ),
            },
            needs={"gold_alert_digest": ["gold_high_risk_alerts"]},
        )


def run_pipeline(spark: SparkSession, raw_dir: str, cfg: PipelineConfig = PipelineConfig()) -> dict[str, int]:
    """Runs every layer and returns the rows written per table."""
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    written = run.bronze(raw_dir)
    for step in (run.silver, run.gold, run.predict, run.alert):
        written |= step()
    return written
