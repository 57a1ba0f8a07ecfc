"""Atomic refresh, incremental loading, rejected records and audit rows of repeated layers."""

import os
import time

import pytest
from cohort import land, raw_tables
from pyspark.sql import functions as F

from cohortlens.config import PipelineConfig
from cohortlens.plans.pipeline import Pipeline
from cohortlens.schemas import RAW_FILES
from cohortlens.sources.audit import SUCCESS, AuditRow, committed, newest_first, write_audit_log
from cohortlens.sources.files import checked_csv
from cohortlens.sources.ingest import Ingest
from cohortlens.sources.tables import create_database, save_table


def broken(n):
    return F.when(F.col("id") == n - 1, F.raise_error(F.lit("fails midway"))).otherwise(F.col("id"))


@pytest.mark.parametrize("buckets", [None, (3, "id")])
def test_a_refresh_that_fails_midway_leaves_the_former_table(spark, buckets):
    create_database(spark, "atomic")
    name = f"atomic.t{'b' if buckets else ''}"
    assert save_table(spark.range(10), name, buckets=buckets) == 10
    reader = spark.table(name)
    for n in (20, 30):
        with pytest.raises(Exception, match="fails midway"):
            save_table(spark.range(n).select(broken(n).cast("long").alias("id")), name, buckets=buckets)
        assert spark.table(name).count() == 10
    assert [r["tableName"] for r in spark.sql("SHOW TABLES IN atomic").collect()].count(name.split(".")[1]) == 1
    assert save_table(spark.range(25), name, buckets=buckets) == 25
    assert spark.table(name).count() == 25
    assert reader.count() == 10  # the version before is still there for who reads it
    for n in (26, 27, 28):
        save_table(spark.range(n), name, buckets=buckets)
    assert spark.table(name).count() == 28
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    folder = described["Location"].removeprefix("file:").rsplit("/", 1)[0]
    versions = [d for d in os.listdir(folder) if d.startswith(name.split(".")[1] + "__")]
    assert len(versions) == 2
    assert not any("__" in r["tableName"] for r in spark.sql("SHOW TABLES IN atomic").collect())


def test_a_table_can_be_refreshed_from_itself_and_change_its_columns(spark):
    create_database(spark, "atomic")
    save_table(spark.range(10), "atomic.own")
    save_table(spark.table("atomic.own").where("id < 4"), "atomic.own")
    assert spark.table("atomic.own").count() == 4
    save_table(spark.table("atomic.own").withColumn("x", F.lit("a")), "atomic.own")
    assert spark.table("atomic.own").columns == ["id", "x"] and spark.table("atomic.own").count() == 4


def drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    (folder / name).write_text("\n".join(["id,v", *lines]) + "\n")


def test_only_new_and_changed_files_are_loaded(spark, tmp_path):
    landing = tmp_path / "in"
    drop(landing / "a b", "one.csv", ["1,x", "2,y"])
    ingest = Ingest(spark, str(landing / "*"), str(tmp_path / "store"), "id int, v string", "test")
    assert ingest.current().count() == 0 and [r.state for r in ingest.pending().collect()] == ["new"]
    first = ingest.run()
    assert first and ingest.run() is None
    drop(landing / "c", "two.csv", ["3,z"])
    second = ingest.run()
    assert {(r.id, r.batch) for r in ingest.current().collect()} == {(1, first), (2, first), (3, second)}
    time.sleep(1.1)
    drop(landing / "a b", "one.csv", ["1,changed"])
    assert [r.state for r in ingest.pending().collect()] == ["changed"]
    ingest.run()
    assert {(r.id, r.v) for r in ingest.current().collect()} == {(1, "changed"), (3, "z")}
    assert ingest.loads().count() == 4 and ingest.ledger().count() == 3
    assert ingest.run() is None


def test_a_load_that_failed_before_its_ledger_entry_is_repeated_once(spark, tmp_path, monkeypatch):
    drop(tmp_path / "in" / "a", "one.csv", ["1,x"])
    ingest = Ingest(spark, str(tmp_path / "in" / "*"), str(tmp_path / "store"), "id int, v string", "test")
    create = spark.createDataFrame
    with monkeypatch.context() as m:
        def lost(data, *rest):
            if data:
                raise RuntimeError("lost")
            return create(data, *rest)
        m.setattr(spark, "createDataFrame", lost)
        with pytest.raises(RuntimeError, match="lost"):
            ingest.run()
    assert ingest.current().count() == 0  # written, not committed
    ingest.run()
    assert [(r.id, r.source_system) for r in ingest.current().collect()] == [(1, "test")]


def test_accepted_and_rejected_records_are_all_lines(spark, tmp_path):
    lines = ["i,b,d,s", "1,true,2020-01-01,a", "x,true,2020-01-01,b", "2,maybe,2020-13-01,c", ",,,", "3,FALSE,,d", "4,true", "5,true,2020-01-02,e,extra"]
    (tmp_path / "t.csv").write_text("\n".join(lines) + "\n")
    accepted, rejected = checked_csv(spark, str(tmp_path / "t.csv"), "s string, i int, b boolean, d date")
    got = sorted((r.s, r.i, r.b, str(r.d)) for r in accepted.na.fill({"s": "-"}).collect())
    assert got == [("-", None, None, "None"), ("a", 1, True, "2020-01-01"), ("d", 3, False, "None")]
    wrong = sorted((r.columns, r.reason, r.record) for r in rejected.collect())
    assert [w[:2] for w in wrong] == [
        ("", "wrong number of fields"), ("", "wrong number of fields"), ("b,d", "value of another type"), ("i", "value of another type")
    ]
    assert {w[2] for w in wrong[:2]} == {"4,true", "5,true,2020-01-02,e,extra"} and '"i":"x"' in wrong[3][2]
    assert accepted.count() + rejected.count() == len(lines) - 1
    assert all(r.file.endswith("t.csv") for r in rejected.collect())
    with pytest.raises(ValueError, match="has no column w"):
        checked_csv(spark, str(tmp_path / "t.csv"), "w int")


def test_quarantine_is_an_audited_table(spark, tmp_path):
    tables = raw_tables(spark, 60)
    bad = F.when(F.col("student_id") < "S100005", F.lit("abc")).otherwise(F.col("avg_score").cast("string"))
    tables["academic"] = tables["academic"].withColumn("avg_score", bad)
    cfg = PipelineConfig(database="quarantine_run", on_malformed="quarantine")
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    written = run.bronze(land(tables, tmp_path))
    assert written["bronze_rejects"] == 5 and written["bronze_academic_performance"] == 55
    assert {written[r.bronze] for n, r in RAW_FILES.items() if n != "academic"} == {60}
    rejects = run.read("bronze_rejects").collect()
    assert {(r.table_name, r.columns) for r in rejects} == {("bronze_academic_performance", "avg_score")}


def test_a_repeated_layer_counts_once(spark):
    create_database(spark, "repeated")
    log = "repeated.log"
    rows = [AuditRow("p", "silver", t, n, SUCCESS) for t, n in (("a", 1), ("b", 2))]
    write_audit_log(spark, log, rows, run_id="r1")
    write_audit_log(spark, log, [AuditRow("p", "silver", "a", 5, SUCCESS)], run_id="r1")
    write_audit_log(spark, log, rows, run_id="r2")
    write_audit_log(spark, log, [AuditRow("p", "gold", "a", 7, SUCCESS)], run_id="r1")
    kept = {(r.run_id, r.layer_name, r.table_name, r.record_count, r.attempt) for r in committed(spark.table(log)).collect()}
    assert kept == {("r1", "silver", "a", 5, 2), ("r1", "silver", "b", 2, 1), ("r2", "silver", "a", 1, 1), ("r2", "silver", "b", 2, 1), ("r1", "gold", "a", 7, 1)}
    assert newest_first(spark.table(log)).count() == 5
