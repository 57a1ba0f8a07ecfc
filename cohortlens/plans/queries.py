"""Named queries over the given tables, one per operator or cohort table.

Timestamps are left out of the results and whole-table means are rounded, so
that a run can be compared value by value with ``oracle.py``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.config import PipelineConfig, Rules
from cohortlens.functions.cleaning import clamp, right_closed_band
from cohortlens.functions.scoring import first_label_by_priority, last_label
from cohortlens.operators import alerts, joins, model, quality
from cohortlens.plans import gold, silver
from cohortlens.plans.pipeline import AUDIT_TABLE, LayerFailed, Pipeline
from cohortlens.schemas import RAW_FILES
from cohortlens.session import shared_folder
from cohortlens.sources.audit import newest_first
from cohortlens.sources.files import checked_csv, manifest, read_csv, stamp, write_csv
from cohortlens.sources.ingest import Ingest
from cohortlens.sources.orders_cohort import OrdersCohort, read_table
from cohortlens.sources.tables import create_database, save_table, written

RULES = Rules()


def _raw(spark: SparkSession, sf: str) -> OrdersCohort:
    return OrdersCohort(spark, sf)


def _silver(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """The named silver tables, or all five."""
    raw = _raw(spark, sf)
    return {name: silver.TRANSFORMS[name](raw.table(name), RULES) for name in names or RAW_FILES}


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return gold.student_risk_profile(_silver(spark, sf), RULES)


def _predictions(profile: DataFrame) -> DataFrame:
    """A stand-in probability any SQL engine can repeat: the score as a fraction."""
    return profile.select("student_id", (F.col("risk_score") / 100).alias("dropout_probability"))


def _new_database(spark: SparkSession) -> str:
    folder = shared_folder(spark)
    name = folder.rsplit("/", 1)[-1].replace("-", "_")
    create_database(spark, name, folder)
    return name


# --- sources, sinks, audit -------------------------------------------------------


def src_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    students = _raw(spark, sf).students()
    path = f"{shared_folder(spark)}/{RAW_FILES['students'].csv}"
    write_csv(students, path)
    return read_csv(spark, path, students.schema)


def src_csv_infer(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{shared_folder(spark)}/{RAW_FILES['socio'].csv}"
    write_csv(_raw(spark, sf).socio(), path)
    return read_csv(spark, path, infer=True)


def _land(raw: OrdersCohort, folder: str, entities=RAW_FILES, keep: str = "true") -> None:
    """The raw tables' rows as CSV files with all columns of the schema, those not derived empty."""
    for name in entities:
        df = raw.table(name).where(keep)
        fields = T.StructType.fromDDL(RAW_FILES[name].schema)
        have = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in fields]
        write_csv(df.select(*have), f"{folder}/{RAW_FILES[name].csv}")


def src_manifest(spark: SparkSession, sf: str) -> DataFrame:
    """The five landing files, and whether each has bytes."""
    root = shared_folder(spark)
    _land(_raw(spark, sf), root)
    files = manifest(spark, root).withColumn("file", F.element_at(F.split("path", "/"), -2))
    data = files.where(F.col("path").endswith(".csv"))
    return data.groupBy("file").agg((F.sum("length") > 0).alias("has_bytes"))


def src_csv_reordered(spark: SparkSession, sf: str) -> DataFrame:
    """All five files with their columns in another order and one too many: rows and non-empty values per column."""
    root, counts = shared_folder(spark), []
    for name, raw in RAW_FILES.items():
        df = _raw(spark, sf).table(name)
        path = f"{root}/{raw.csv}"
        write_csv(df.select(F.lit("x").alias("more"), *reversed(df.columns)), path)
        back = read_csv(spark, path, df.schema)
        per_column = [
            F.struct(F.lit(raw.csv).alias("file"), F.lit(c).alias("column_name"), F.col("rows"), F.col(c).alias("filled"))
            for c in back.columns
        ]
        measured = back.agg(F.count("*").alias("rows"), *[F.count(c).alias(c) for c in back.columns])
        counts.append(measured.select(F.inline(F.array(*per_column))))
    return reduce(DataFrame.unionByName, counts)


def src_csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """A file with wrong values by rule: how many records fit, and how many were rejected for which columns."""
    k = F.substring("student_id", 2, 12).cast("long") - 100_000
    df = _raw(spark, sf).academic().withColumns(
        {
            "avg_score": F.when(k % 37 == 0, "n/a").otherwise(F.col("avg_score").cast("string")),
            "failed_subjects": F.when(k % 41 == 0, "two").otherwise(F.col("failed_subjects").cast("string")),
        }
    )
    path = f"{shared_folder(spark)}/{RAW_FILES['academic'].csv}"
    write_csv(df, path)
    accepted, rejected = checked_csv(spark, path, "student_id string, avg_score double, failed_subjects int")
    fits = accepted.select(F.lit("accepted").alias("outcome"), F.lit("").alias("columns"))
    wrong = rejected.select(F.col("reason").alias("outcome"), "columns")
    return fits.unionByName(wrong).groupBy("outcome", "columns").agg(F.count("*").alias("records"))


def src_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The five tables landed in two halves and loaded in three runs: rows that each run loads."""
    folder, raw, loaded = shared_folder(spark), _raw(spark, sf), []
    even = "cast(substring(student_id, 2) AS bigint) % 2 = 0"
    ingests = {
        name: Ingest(spark, f"{folder}/landing/*/{r.csv}", f"{folder}/store/{name}", r.schema, "synthetic_csv")
        for name, r in RAW_FILES.items()
    }
    batches = {name: [] for name in RAW_FILES}
    for run, half in ((1, even), (2, f"NOT {even}"), (3, None)):
        if half:
            _land(raw, f"{folder}/landing/drop-{run}", keep=half)
        for name, ingest in ingests.items():
            batches[name].append(ingest.run())
    for name, ingest in ingests.items():
        rows = ingest.current()
        counts = [F.count_if(F.col("batch") == F.lit(b)) if b else F.lit(0).cast("long") for b in batches[name]]
        runs = [F.struct(F.lit(i).alias("run"), F.col(f"n{i}").alias("rows")) for i in (1, 2, 3)]
        measured = rows.agg(*[c.alias(f"n{i}") for i, c in enumerate(counts, 1)])
        loaded.append(measured.select(F.lit(name).alias("table_name"), F.inline(F.array(*runs))))
    return reduce(DataFrame.unionByName, loaded)


def bronze_stamp(spark: SparkSession, sf: str) -> DataFrame:
    stamped = stamp(_raw(spark, sf).socio(), "synthetic_csv")
    return stamped.withColumn("is_stamped", F.col("created_timestamp").isNotNull()).drop("created_timestamp")


def snk_overwrite_table(spark: SparkSession, sf: str) -> DataFrame:
    """The second of two refreshes; a third one that fails leaves it as it is."""
    table = f"{_new_database(spark)}.{RAW_FILES['retention'].silver}"
    cleaned = silver.retention(_raw(spark, sf).retention()).drop("updated_timestamp")
    save_table(cleaned.where("retention_risk_flag"), table)
    save_table(cleaned, table)
    broken = F.when(F.col("retention_risk_flag"), F.raise_error(F.lit("fails midway"))).otherwise(F.col("dropout_reason"))
    try:
        save_table(cleaned.withColumn("dropout_reason", broken.cast("string")), table)
    except Exception as failed:
        if "fails midway" not in str(failed):
            raise
    return spark.table(table)


def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    """A whole run from CSV files, its silver layer repeated, and a table that fails."""
    landing = shared_folder(spark)
    _land(_raw(spark, sf), landing)
    run = Pipeline(spark, PipelineConfig(database=_new_database(spark)))
    run.bronze(landing)
    for step in (run.silver, run.silver, run.gold, run.predict, run.alert):
        step()
    try:
        run.write_layer("extra", {"gold_of_nothing": lambda: run.read("no_such_table")})
    except LayerFailed:
        pass  # recorded, which is what this query shows
    return newest_first(run.read(AUDIT_TABLE)).drop("run_timestamp")


# --- counts and quality ----------------------------------------------------------


def agg_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    return quality.row_counts({name: raw.table(name) for name in RAW_FILES})


def agg_global_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _raw(spark, sf).academic().agg(F.round(F.avg("avg_score"), 6).alias("mean_score"))


def dq_profile(spark: SparkSession, sf: str) -> DataFrame:
    return quality.profile(_raw(spark, sf).students(), exact_distinct=True)


def dq_unique_key(spark: SparkSession, sf: str) -> DataFrame:
    return quality.key_check(silver.students(_raw(spark, sf).students()), "student_id")


def dq_repeated_key(spark: SparkSession, sf: str) -> DataFrame:
    """The same check where keys do repeat: orders per customer."""
    return quality.key_check(read_table(spark, sf, "orders"), "o_custkey")


def dq_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Which silver tables hold which students, where some attendance ids come padded."""
    tables = _silver(spark, sf)
    own = F.col("student_id")
    padded = F.when(F.substring(own, -1, 1) == "3", F.concat(F.lit(" "), own)).otherwise(own)
    tables["attendance"] = tables["attendance"].withColumn("student_id", padded)
    return quality.orphans(tables, "student_id")


def dq_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The newest order of every customer, and by what each other order lost."""
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    best = {"o_orderdate": F.col("o_orderdate"), "o_orderkey": F.col("o_orderkey")}
    return quality.resolve_repeats(orders, "o_custkey", best, hot_rows=20).drop("o_orderdate")


def dq_inject_errors(spark: SparkSession, sf: str) -> DataFrame:
    students = silver.students(_raw(spark, sf).students()).drop("updated_timestamp")
    for column, fraction, value in [
        ("region", 0.08, F.lower("region")),
        ("gender", 0.03, F.lit(None)),
        ("grade_level", 0.02, F.lit(15)),
    ]:
        students = quality.inject_errors(students, column, fraction, value, "student_id", 42)
    return students


def dq_rejects(spark: SparkSession, sf: str) -> DataFrame:
    rejected = silver.student_rejects(_raw(spark, sf).students())
    return rejected.select("student_id", "grade_level", "enrollment_year", "reject_reason")


# --- silver ----------------------------------------------------------------------


def silver_students(spark: SparkSession, sf: str) -> DataFrame:
    return silver.students(_raw(spark, sf).students()).drop("updated_timestamp")


def silver_academic(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = silver.academic(_raw(spark, sf).academic()).drop("updated_timestamp")
    return cleaned.withColumn("avg_score", F.round("avg_score", 4))


def silver_academic_valid_mean(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = silver.academic(_raw(spark, sf).academic(), Rules(mean_over="valid")).drop("updated_timestamp")
    return cleaned.withColumn("avg_score", F.round("avg_score", 4))


def silver_academic_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = silver.academic_summary(silver.academic(_raw(spark, sf).academic()))
    return summary.withColumn("avg_perf_score", F.round("avg_perf_score", 6))


def silver_attendance(spark: SparkSession, sf: str) -> DataFrame:
    return silver.attendance(_raw(spark, sf).attendance()).drop("updated_timestamp")


def silver_attendance_repaired_first(spark: SparkSession, sf: str) -> DataFrame:
    rules = Rules(repair_denominator_first=True)
    return silver.attendance(_raw(spark, sf).attendance(), rules).drop("updated_timestamp")


def silver_socio(spark: SparkSession, sf: str) -> DataFrame:
    return silver.socio(_raw(spark, sf).socio()).drop("updated_timestamp")


def silver_audit_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Every silver table keeps its bronze time of creation and gains one of its update."""
    raw, checked = _raw(spark, sf), []
    for name, transform in silver.TRANSFORMS.items():
        bronze = stamp(raw.table(name), "synthetic_csv").withColumn("created_timestamp", F.lit("2020-02-02").cast("timestamp"))
        cleaned = transform(bronze, RULES)
        kept = (F.col("created_timestamp") == F.lit("2020-02-02").cast("timestamp")).alias("is_kept")
        updated = (F.col("updated_timestamp") > F.col("created_timestamp")).alias("is_updated")
        checked.append(cleaned.select(F.lit(name).alias("table_name"), kept, updated, "source_system"))
    keys = ["table_name", "is_kept", "is_updated", "source_system"]
    return reduce(DataFrame.unionByName, checked).groupBy(*keys).agg(F.count("*").alias("rows"))


def silver_retention(spark: SparkSession, sf: str) -> DataFrame:
    return silver.retention(_raw(spark, sf).retention()).drop("updated_timestamp")


def silver_retention_summary(spark: SparkSession, sf: str) -> DataFrame:
    return silver.retention_summary(silver.retention(_raw(spark, sf).retention()))


def label_factor_count(spark: SparkSession, sf: str) -> DataFrame:
    tables = _silver(spark, sf, "academic", "attendance", "socio")
    return silver.factor_count_label(tables["academic"], tables["attendance"], tables["socio"])


def score_clip_band(spark: SparkSession, sf: str) -> DataFrame:
    score = F.col("avg_score")
    clipped = _raw(spark, sf).academic().select("student_id", clamp(score, 30.0, 95.0).alias("avg_score"))
    return clipped.withColumns(
        {
            "improvement_flag": score > 60,
            "performance_band": right_closed_band(score, [0, 50, 70, 100], ["Low", "Medium", "High"]),
        }
    )


# --- gold ------------------------------------------------------------------------


def join_left_star(spark: SparkSession, sf: str) -> DataFrame:
    return gold.joined_flags(_silver(spark, sf))


def join_left_star_split(spark: SparkSession, sf: str) -> DataFrame:
    """The star join with every key taken for hot: all rows go through the grid."""
    tables = _silver(spark, sf)
    return gold.joined_flags(tables, joins.hot_keys(tables, "student_id", hot_rows=0))


def join_hot_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with their orders, busy customers' orders dealt over several tasks."""
    tables = {
        "customers": read_table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment"),
        "orders": read_table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey", "o_orderstatus"),
    }
    return joins.split_star_join(tables, "k", "left", joins.hot_keys(tables, "k", hot_rows=4))


def gold_risk_score(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf).select("student_id", "risk_score", "risk_level", "intervention_required")


def gold_primary_driver(spark: SparkSession, sf: str) -> DataFrame:
    by_weight = [("attendance_risk_flag", "ATTENDANCE"), ("academic_risk_flag", "ACADEMIC"), ("socio_economic_risk_flag", "SOCIO_ECONOMIC")]
    return gold.joined_flags(_silver(spark, sf)).select(
        "student_id",
        last_label(RULES.flag_labels).alias("primary_risk_driver"),
        first_label_by_priority(by_weight).alias("driver_by_priority"),
    )


def gold_student_risk_profile(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf)


def gold_attendance_vs_performance(spark: SparkSession, sf: str) -> DataFrame:
    return gold.attendance_vs_performance(_silver(spark, sf, "students", "attendance", "academic"), RULES)


def gold_dropout_trends(spark: SparkSession, sf: str) -> DataFrame:
    return gold.dropout_trends(_silver(spark, sf, "students", "retention"), RULES)


def gold_intervention_candidates(spark: SparkSession, sf: str) -> DataFrame:
    tables = _silver(spark, sf)
    return gold.intervention_candidates(gold.student_risk_profile(tables, RULES), tables["retention"])


def gold_retention_overview(spark: SparkSession, sf: str) -> DataFrame:
    return gold.retention_overview(silver.retention(_raw(spark, sf).retention()), RULES)


def gold_walkthrough(spark: SparkSession, sf: str) -> DataFrame:
    # The output columns.
    columns = [
        "student_id",
        "grade_level",
        "attendance_pct",
        "performance_score",
        "risk_score",
        "risk_level",
        "primary_risk_driver",
        "intervention_required",
    ]
    return gold.preview(_profile(spark, sf), columns, RULES.walkthrough_top_k)


# --- model -----------------------------------------------------------------------


def ml_features(spark: SparkSession, sf: str) -> DataFrame:
    return model.features(_profile(spark, sf))


def ml_hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return model.with_split(model.features(_profile(spark, sf))).select("student_id", "is_train")


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    train, test = model.split(written(model.features(_profile(spark, sf))))
    return model.score(model.fit(model.assemble(train), tol=1e-9), test)


def ml_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Probabilities of the test part, fitted close enough to the optimum for three digits."""
    return _scored(spark, sf).select("student_id", F.round("dropout_probability", 3).alias("dropout_probability"))


def ml_model_auc(spark: SparkSession, sf: str) -> DataFrame:
    return model.auc_by_rank(_scored(spark, sf)).select(F.round("auc", 6).alias("auc"))


def ml_scored_students(spark: SparkSession, sf: str) -> DataFrame:
    """Who was scored, and whether the score is a probability."""
    p = F.col("dropout_probability")
    return _scored(spark, sf).select("student_id", p.between(0, 1).alias("is_probability"), "label")


def ml_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """At the optimum the training rows' probabilities add up to their positive labels."""
    train, _ = model.split(written(model.features(_profile(spark, sf))))
    return model.score(model.fit(model.assemble(train)), train).agg(
        F.count("*").alias("train_rows"),
        F.sum("label").alias("dropped"),
        F.round(F.sum("dropout_probability"), 0).alias("expected_dropped"),
    )


def ml_score_equations(spark: SparkSession, sf: str) -> DataFrame:
    """Each term's sum over positive training rows, and the share of it that the fit explains: 1 at the optimum."""
    train, _ = model.split(written(model.features(_profile(spark, sf))))
    sums = model.score_equations(model.score(model.fit(model.assemble(train)), train))
    explained = F.round(F.col("expected") / F.col("observed"), 4).alias("explained")
    return sums.select("term", F.round("observed", 4).alias("observed"), explained)


def ml_gram(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = model.split(model.features(_profile(spark, sf)))
    return model.gram(model.assemble(train)).withColumn("product", F.round("product", 2))


def ml_auc_rank(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("retention_risk_flag"), 1).otherwise(0).alias("label")
    scored = _profile(spark, sf).select(F.col("risk_score").cast("double"), label)
    return model.auc_by_rank(scored, "risk_score").select(F.round("auc", 6).alias("auc"))


# --- alerts ----------------------------------------------------------------------


def pred_with_risk_topk(spark: SparkSession, sf: str) -> DataFrame:
    profile = written(_profile(spark, sf))
    return alerts.predictions_with_risk(_predictions(profile), profile, RULES.walkthrough_top_k)


def _alert_profile(spark: SparkSession, sf: str) -> DataFrame:
    """What alerts and their breakdowns read of the profile, stored once."""
    return written(_profile(spark, sf).select("student_id", "risk_score", "primary_risk_driver", "grade_level"))


def _alerts(profile: DataFrame) -> DataFrame:
    return alerts.high_risk(_predictions(profile), RULES.alert_probability)


def alert_threshold_ge(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.stamped(_alerts(_profile(spark, sf))).drop("alert_generated_timestamp")


def alert_threshold_gt(spark: SparkSession, sf: str) -> DataFrame:
    predictions = _predictions(_profile(spark, sf))
    return alerts.by_probability(alerts.high_risk(predictions, RULES.alert_probability, inclusive=False))


def alert_ranked(spark: SparkSession, sf: str) -> DataFrame:
    """All alerts with their place in the order of the alert list."""
    return alerts.ranked(_alerts(_profile(spark, sf)))


def alert_count(spark: SparkSession, sf: str) -> DataFrame:
    return _alerts(_profile(spark, sf)).agg(F.count("*").alias("high_risk_count"))


def alert_topk(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.top_k(_alerts(_profile(spark, sf)), RULES.alert_top_k)


def alert_driver_counts(spark: SparkSession, sf: str) -> DataFrame:
    profile = _alert_profile(spark, sf)
    return alerts.driver_counts(_alerts(profile), profile)


def alert_grade_counts(spark: SparkSession, sf: str) -> DataFrame:
    profile = _alert_profile(spark, sf)
    return alerts.grade_counts(_alerts(profile), profile)


def alert_breakdown_sets(spark: SparkSession, sf: str) -> DataFrame:
    profile = _alert_profile(spark, sf)
    return alerts.driver_and_grade_counts(_alerts(profile), profile)


def alert_digest(spark: SparkSession, sf: str) -> DataFrame:
    profile = _alert_profile(spark, sf)
    return alerts.digest(_alerts(profile), profile, RULES.alert_top_k)


def _cohort_status(spark: SparkSession, sf: str) -> DataFrame:
    tables = _silver(spark, sf, "students", "retention")
    students = tables["students"].select("student_id", "region", "enrollment_year")
    status = tables["retention"].select("student_id", "retention_risk_flag")
    return joins.star_join(students, [status], "student_id", "inner")


def alert_institution_trend(spark: SparkSession, sf: str) -> DataFrame:
    tables = _silver(spark, sf, "students", "retention")
    return alerts.institution_trend(tables["students"], tables["retention"], RULES.trend_min_increase)


def alert_region_trend(spark: SparkSession, sf: str) -> DataFrame:
    return alerts.rate_trend(_cohort_status(spark, sf), "enrollment_year", "retention_risk_flag", by=["region"])


def alert_order_trend(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("order_year"), (F.col("o_orderstatus") == "F").alias("is_final")
    )
    return alerts.rate_trend(orders, "order_year", "is_final")


def alert_event_trend(spark: SparkSession, sf: str) -> DataFrame:
    """The share of errors among events, minute by minute."""
    events = read_table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd HH:mm").alias("minute"), (F.col("event_type") == "error").alias("is_error")
    )
    return alerts.rate_trend(events, "minute", "is_error")


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in [
        src_csv_scan,
        src_csv_infer,
        src_manifest,
        src_csv_reordered,
        src_csv_rejects,
        src_incremental,
        bronze_stamp,
        snk_overwrite_table,
        audit_log,
        agg_row_counts,
        agg_global_mean,
        dq_profile,
        dq_unique_key,
        dq_repeated_key,
        dq_orphans,
        dq_dedup,
        dq_inject_errors,
        dq_rejects,
        silver_students,
        silver_academic,
        silver_academic_valid_mean,
        silver_academic_summary,
        silver_attendance,
        silver_attendance_repaired_first,
        silver_socio,
        silver_audit_stamp,
        silver_retention,
        silver_retention_summary,
        label_factor_count,
        score_clip_band,
        join_left_star,
        join_left_star_split,
        join_hot_keys,
        gold_risk_score,
        gold_primary_driver,
        gold_student_risk_profile,
        gold_attendance_vs_performance,
        gold_dropout_trends,
        gold_intervention_candidates,
        gold_retention_overview,
        gold_walkthrough,
        ml_features,
        ml_hash_split,
        ml_predictions,
        ml_scored_students,
        ml_calibration,
        ml_score_equations,
        ml_gram,
        ml_auc_rank,
        ml_model_auc,
        pred_with_risk_topk,
        alert_threshold_ge,
        alert_threshold_gt,
        alert_ranked,
        alert_count,
        alert_topk,
        alert_driver_counts,
        alert_grade_counts,
        alert_breakdown_sets,
        alert_digest,
        alert_institution_trend,
        alert_region_trend,
        alert_order_trend,
        alert_event_trend,
    ]
}
