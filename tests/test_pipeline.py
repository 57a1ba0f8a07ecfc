"""The whole run from CSV files, its audit trail, and what happens when a table fails."""

import pytest
from cohort import land, raw_tables, with_errors
from pyspark.sql import functions as F

from cohortlens.config import PipelineConfig
from cohortlens.operators.quality import RepeatedKeyError
from cohortlens.plans import gold
from cohortlens.plans.pipeline import LayerFailed, Pipeline, run_pipeline
from cohortlens.schemas import RAW_FILES
from cohortlens.sources.audit import newest_first
from cohortlens.sources.files import manifest, read_csv, write_csv
from cohortlens.sources.tables import create_database, save_table

N = 5500


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    return land(with_errors(raw_tables(spark, N)), tmp_path_factory.mktemp("landing"))


@pytest.fixture(scope="module")
def clean_landing(spark, tmp_path_factory):
    return land(raw_tables(spark, N), tmp_path_factory.mktemp("clean"))


@pytest.fixture(scope="module")
def dirty_run(spark, landing):
    cfg = PipelineConfig(database="dirty_run")
    return cfg, run_pipeline(spark, landing, cfg)


@pytest.fixture(scope="module")
def clean_run(spark, clean_landing):
    cfg = PipelineConfig(database="clean_run", infer_schema=True, score_on="all", split="random")
    return cfg, run_pipeline(spark, clean_landing, cfg)


def test_every_table_is_written_and_audited(spark, dirty_run):
    cfg, written = dirty_run
    tables = {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {cfg.database}").collect()}
    assert tables == set(written) | {"pipeline_audit_log"}
    log = spark.table(cfg.table("pipeline_audit_log"))
    audited = {r["table_name"]: (r["record_count"], r["run_status"], r["error_message"]) for r in log.collect()}
    assert audited == {name: (spark.table(cfg.table(name)).count(), "SUCCESS", None) for name in written}
    times = [r["run_timestamp"] for r in newest_first(log).collect()]
    assert times == sorted(times, reverse=True)
    assert {r["pipeline_name"] for r in log.collect()} == {cfg.pipeline_name}


def test_counts_of_the_layers(spark, dirty_run):
    cfg, written = dirty_run
    assert all(written[raw.bronze] == N for raw in RAW_FILES.values())
    assert written["silver_students"] < N
    assert all(written[raw.silver] == N for name, raw in RAW_FILES.items() if name != "students")
    assert written["gold_student_risk_profile"] == written["silver_students"]
    assert written["gold_dropout_trends"] == 5 * 7
    assert written["gold_retention_overview"] == 1
    overview = spark.table(cfg.table("gold_retention_overview")).first()
    assert overview["retained_students"] + overview["dropped_students"] == overview["total_students"] == N
    trends = spark.table(cfg.table("gold_dropout_trends")).agg(F.sum("total_students")).first()[0]
    assert trends == written["silver_students"]


def test_cleaned_values_are_in_their_domains(spark, dirty_run):
    cfg, _ = dirty_run

    def values(table, column):
        return {r[0] for r in spark.table(cfg.table(table)).select(column).distinct().collect()}

    assert values("silver_students", "region") == {"NORTH", "SOUTH", "EAST", "WEST", "CENTRAL"}
    assert values("silver_students", "gender") == {"Male", "Female", "UNKNOWN"}
    assert values("silver_socio_economic", "family_income_band") == {"LOW", "MIDDLE", "HIGH", "UNKNOWN"}
    assert values("silver_socio_economic", "access_to_internet") == {True, False}
    assert values("silver_retention_status", "retention_status") == {"DROPPED", "RETAINED"}
    assert values("gold_student_risk_profile", "risk_score") <= {0, 30, 40, 60, 70, 100}
    pct = spark.table(cfg.table("silver_attendance")).agg(F.min("attendance_pct"), F.max("attendance_pct")).first()
    assert tuple(pct) == (0.0, 100.0)


def test_columns_of_the_profile_and_predictions(spark, dirty_run):
    cfg, written = dirty_run
    assert len(spark.table(cfg.table("gold_student_risk_profile")).columns) == 17
    predictions = spark.table(cfg.table("gold_dropout_predictions"))
    assert predictions.columns == ["student_id", "dropout_probability"]
    assert predictions.where("dropout_probability NOT BETWEEN 0 AND 1").isEmpty()
    assert 0.17 < written["gold_dropout_predictions"] / written["gold_student_risk_profile"] < 0.23
    alerts = spark.table(cfg.table("gold_high_risk_alerts"))
    assert alerts.count() == predictions.where("dropout_probability >= 0.7").count() > 0


def test_auc_is_the_documented_one(spark, clean_run):
    """About 0.90 on clean files; the draws differ, so a band."""
    cfg, written = clean_run
    assert 0.87 < spark.table(cfg.table("gold_model_metrics")).first()["auc"] < 0.94
    assert written["gold_dropout_predictions"] == N


def test_cleaning_clean_tables_changes_nothing(spark, dirty_run):
    """A second pass over silver gives silver again, the mean imputation aside."""
    from cohortlens.plans import silver

    cfg, _ = dirty_run
    for name in ("students", "attendance", "socio", "retention"):
        once = spark.table(cfg.table(RAW_FILES[name].silver))
        twice = silver.TRANSFORMS[name](once.drop("updated_timestamp")).select(*once.columns)
        assert once.drop("updated_timestamp").exceptAll(twice.drop("updated_timestamp")).isEmpty()


def test_second_run_replaces_tables_and_appends_to_the_log(spark, dirty_run, landing):
    cfg, written = dirty_run
    log = cfg.table("pipeline_audit_log")
    before = spark.table(log).count()
    assert Pipeline(spark, cfg).silver() == {raw.silver: written[raw.silver] for raw in RAW_FILES.values()}
    assert spark.table(log).count() == before + 5


def test_failure_is_recorded_and_stops_the_run(spark, tmp_path, clean_landing):
    cfg = PipelineConfig(database="failed_run")
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    with pytest.raises(LayerFailed, match="bronze: bronze_students"):
        run.bronze(str(tmp_path / "nowhere"))
    log = spark.table(cfg.table("pipeline_audit_log")).collect()
    assert {r["run_status"] for r in log} == {"FAILED"} and len(log) == 5
    assert all(r["record_count"] is None and "PATH_NOT_FOUND" in r["error_message"] for r in log)


def test_failed_fit_is_recorded(spark, dirty_run):
    """Without any student the fit fails: both model tables are recorded as failed."""
    cfg = PipelineConfig(database="failed_fit")
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    empty = spark.table(dirty_run[0].table("gold_student_risk_profile")).limit(0)
    save_table(empty, cfg.table("gold_student_risk_profile"))
    with pytest.raises(LayerFailed, match="ml: gold_dropout_predictions"):
        run.predict()
    log = spark.table(cfg.table("pipeline_audit_log")).collect()
    assert {r["table_name"]: r["run_status"] for r in log} == {"gold_dropout_predictions": "FAILED", "gold_model_metrics": "FAILED"}


def test_failure_inside_a_task_is_recorded(spark):
    cfg = PipelineConfig(database="task_failure")
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    bad = spark.range(10).select(F.raise_error(F.lit("broken row")).cast("int").alias("x"))
    with pytest.raises(LayerFailed, match="silver: bad"):
        run.write_layer("silver", {"good": lambda: spark.range(3), "bad": lambda: bad})
    got = {r["table_name"]: (r["run_status"], r["record_count"]) for r in spark.table(cfg.table("pipeline_audit_log")).collect()}
    assert got == {"good": ("SUCCESS", 3), "bad": ("FAILED", None)}


def test_hot_and_repeated_keys(spark, tmp_path):
    """A third of the student rows share one id: the run splits it and loses nothing."""
    tables = raw_tables(spark, 300)
    copies = tables["students"].where("student_id = 'S100007'").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(150)))).drop("i")
    tables["students"] = tables["students"].unionByName(copies)
    folder = land(tables, tmp_path)
    cfg = PipelineConfig(database="hot_run", hot_key_rows=20, on_repeated_key="multiply")
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    run.bronze(folder)
    run.silver()
    assert [tuple(r)[:2] for r in run.hot_keys(run.silver_tables()).collect()] == [("S100007", 151)]
    written = run.gold()
    assert written["gold_student_risk_profile"] == 450
    plain = Pipeline(spark, PipelineConfig(database="hot_run", on_repeated_key="multiply"))
    assert plain.hot_keys(plain.silver_tables()) is None
    kept = spark.table("hot_run.gold_student_risk_profile").persist()
    kept.count()
    assert plain.gold() == written
    again = spark.table("hot_run.gold_student_risk_profile")
    assert kept.exceptAll(again).isEmpty() and again.exceptAll(kept).isEmpty()
    with pytest.raises(RepeatedKeyError, match="silver_students: 1 values of student_id"):
        Pipeline(spark, PipelineConfig(database="hot_run", on_repeated_key="fail")).gold()


def test_many_missing_ids_are_spread(spark, tmp_path):
    """A third of the students have no id: they match nothing and stay in the profile."""
    tables = raw_tables(spark, 300)
    lost = F.when(F.col("grade_level") < 8, F.lit(None)).otherwise(F.col("student_id"))
    tables["students"] = tables["students"].withColumn("student_id", lost)
    cfg = PipelineConfig(database="lost_ids", hot_key_rows=40)
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    run.bronze(land(tables, tmp_path))
    run.silver()
    assert [r["student_id"] for r in run.hot_keys(run.silver_tables()).collect()] == [None]
    assert run.gold()["gold_student_risk_profile"] == 300
    missing = run.read("gold_student_risk_profile").where("student_id IS NULL")
    assert missing.count() > 50 and missing.where("risk_score <> 0 OR retention_status IS NOT NULL").isEmpty()


def test_bucketed_silver_tables_join_without_exchange(spark, dirty_run, landing):
    cfg = PipelineConfig(database="bucketed_run", silver_buckets=4)
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    run.bronze(landing)
    assert run.silver() == {raw.silver: dirty_run[1][raw.silver] for raw in RAW_FILES.values()}
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        profile = gold.student_risk_profile(run.silver_tables())
        plan = profile._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == 4 and "Exchange" not in plan
        unbucketed = gold.student_risk_profile(Pipeline(spark, dirty_run[0]).silver_tables())
        assert unbucketed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 5
        assert profile.exceptAll(unbucketed).isEmpty() and profile.count() == unbucketed.count()
    finally:
        spark.conf.set(limit, before)


def test_only_the_table_with_a_hot_key_has_no_buckets(spark, tmp_path):
    tables = raw_tables(spark, 200)
    copies = tables["socio"].where("student_id = 'S100007'").withColumn("i", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("i")
    tables["socio"] = tables["socio"].unionByName(copies)
    cfg = PipelineConfig(database="hot_bucket_run", silver_buckets=4, hot_key_rows=20, on_repeated_key="multiply")
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    run.bronze(land(tables, tmp_path))
    run.silver()

    def bucketed(entity):
        described = spark.sql(f"DESCRIBE EXTENDED {cfg.table(RAW_FILES[entity].silver)}").collect()
        return any(r["col_name"] == "Num Buckets" for r in described)

    assert {e for e in RAW_FILES if not bucketed(e)} == {"socio"}
    assert run.gold()["gold_student_risk_profile"] == run.read("silver_students").count() + 60


def test_observed_count_of_an_empty_write(spark):
    create_database(spark, "empty_write")
    assert save_table(spark.range(0), "empty_write.a") == 0
    none = spark.range(10).where("id < 0")
    assert save_table(none.join(spark.range(5), "id"), "empty_write.b") == 0


def test_csv_keeps_padding_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(" a ", None, 1.5), (None, "N/A", None)], "x string, y string, z double")
    write_csv(df, str(tmp_path / "t.csv"))
    back = read_csv(spark, str(tmp_path / "t.csv"), df.schema)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    assert read_csv(spark, str(tmp_path / "t.csv"), infer=True).dtypes == df.dtypes
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "t.csv"))


def test_manifest_lists_files(spark, clean_landing):
    files = manifest(spark, clean_landing).where(F.col("path").endswith(".csv")).collect()
    assert len(files) == 10 and all(r["length"] > 0 and r["modificationTime"] for r in files)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    df = spark.createDataFrame([(1.5, "a", "x"), (None, "b", "y")], "z double, x string, extra string")
    write_csv(df, str(tmp_path / "t.csv"))
    back = read_csv(spark, str(tmp_path / "t.csv"), "x string, z double")
    assert sorted(back.collect()) == [("a", 1.5), ("b", None)]
    with pytest.raises(ValueError, match="has no column w"):
        read_csv(spark, str(tmp_path / "t.csv"), "x string, w int")


def test_malformed_values_are_audited(spark, tmp_path):
    tables = raw_tables(spark, 60)
    shuffled = tables["academic"].select(*reversed(tables["academic"].columns))
    bad = F.when(F.col("student_id") < "S100005", F.lit("abc")).otherwise(F.col("avg_score").cast("string"))
    folder = land(tables | {"academic": shuffled.withColumn("avg_score", bad)}, tmp_path)
    cfg = PipelineConfig(database="malformed_run")
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    run.bronze(folder)
    n = tables["academic"].where("student_id < 'S100005'").count()
    stored = run.read("bronze_academic_performance")
    assert stored.where("avg_score IS NULL").count() >= n > 0 and "_malformed_record" not in stored.columns
    kept = stored.where("student_id >= 'S100005'").select("student_id", "avg_score", "failed_subjects")
    given = tables["academic"].where("student_id >= 'S100005'").selectExpr(
        "student_id", "cast(avg_score AS double)", "cast(failed_subjects AS int)"
    )
    assert kept.exceptAll(given).isEmpty() and kept.count() == given.count()
    log = {r["table_name"]: (r["run_status"], r["error_message"]) for r in run.read("pipeline_audit_log").collect()}
    assert log.pop("bronze_academic_performance") == ("SUCCESS", f"{n} malformed records")
    assert set(log.values()) == {("SUCCESS", None)}


def test_a_table_does_not_run_on_a_failed_one(spark, dirty_run):
    cfg = PipelineConfig(database="stale_run")
    create_database(spark, cfg.database)
    run = Pipeline(spark, cfg)
    run.write_layer("gold", {"first": lambda: spark.range(3)})

    def broken():
        raise ValueError("broken plan")

    with pytest.raises(LayerFailed, match="gold: first, second, third"):
        later = {"second": lambda: run.read("first"), "third": lambda: run.read("second")}
        run.write_layer("gold", {"first": broken, **later}, needs={"second": ["first"], "third": ["second"]})
    log = run.read("pipeline_audit_log").where("run_status = 'FAILED'").collect()
    assert {r["table_name"]: r["error_message"] for r in log} == {
        "first": "broken plan", "second": "not run: first failed", "third": "not run: second failed"
    }


def test_the_run_writes_the_institution_trend(spark, dirty_run):
    cfg, written = dirty_run
    trend = spark.table(cfg.table("gold_institution_trend"))
    assert trend.count() == written["gold_institution_trend"] > 1
    assert trend.agg(F.sum("total")).first()[0] == written["silver_students"]
