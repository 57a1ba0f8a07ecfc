"""Silver layer: one cleaning transform per raw table.

All steps are row-wise, so a transform is a map-only plan over its scan. The one
whole-table value, the mean score, enters as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.config import Rules
from cohortlens.functions.cleaning import (
    bound_count,
    clamp,
    impute_or_cap,
    is_true,
    keep_if_in,
    percentage,
    positive_or,
    to_boolean,
    trim_all,
    upper_or,
)
from cohortlens.functions.scoring import factor_count
from cohortlens.operators.quality import rejects
from cohortlens.operators.rates import counts_by, global_mean

YES_NO = ("access_to_internet", "working_part_time", "scholarship_status")


def _updated() -> dict[str, Column]:
    return {"updated_timestamp": F.current_timestamp()}


def student_rules(rules: Rules = Rules()) -> dict[str, Column]:
    """What a student row must meet to be kept, by reject reason."""
    return {
        "grade_level out of range": F.col("grade_level").between(*rules.grade_range),
        "enrollment_year too early": F.col("enrollment_year") >= rules.first_enrollment_year,
    }


def students(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    cleaned = raw.withColumns(trim_all(["student_id", "gender", "region", "school_id", "program_type"])).withColumns(
        {
            "region": F.upper("region"),
            "program_type": F.upper("program_type"),
            "gender": keep_if_in(F.col("gender"), rules.genders, rules.unknown),
            **_updated(),
        }
    )
    for ok in student_rules(rules).values():
        cleaned = cleaned.where(ok)
    return cleaned


def student_rejects(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows ``students`` leaves out, each with its reason."""
    return rejects(raw, student_rules(rules))


def academic(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    score, failed = F.col("avg_score"), F.col("failed_subjects")
    low, high = rules.score_range
    valid = score.between(low, high) if rules.mean_over == "valid" else None
    mean = global_mean(raw, "avg_score", valid)
    return (
        raw.withColumns(
            {
                "avg_score": impute_or_cap(score, mean, low, high),
                "failed_subjects": clamp(failed, *rules.failed_range),
                **_updated(),
            }
        )
        .withColumn("performance_score", F.round(score - failed * rules.points_per_failure, 2))
        .withColumn(
            "academic_risk_flag",
            is_true((F.col("performance_score") < rules.passing_score) | (failed >= rules.failed_limit)),
        )
    )


def attendance(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    total = positive_or(F.col("total_days"), rules.default_school_days)
    bound_by = total if rules.repair_denominator_first else F.col("total_days")
    return (
        raw.withColumns(
            {"days_present": bound_count(F.col("days_present"), bound_by), "total_days": total, **_updated()}
        )
        .withColumn("attendance_pct", percentage(F.col("days_present"), F.col("total_days")))
        .withColumn("attendance_risk_flag", is_true(F.col("attendance_pct") < rules.attendance_target))
    )


def socio(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    cleaned = raw.withColumns(
        {
            "family_income_band": upper_or(F.col("family_income_band"), rules.unknown),
            **trim_all(["parental_education"]),
            **{c: to_boolean(F.col(c)) for c in YES_NO},
            **_updated(),
        }
    )
    at_risk = (F.col("family_income_band") == rules.low_income) | F.col("working_part_time")
    return cleaned.withColumn("socio_economic_risk_flag", is_true(at_risk))


def retention(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The status follows the flag, whatever the source's status said."""
    dropped = is_true(F.col("dropout_flag"))
    reason = F.coalesce("dropout_reason", F.lit(rules.reason_missing))
    return raw.withColumns(
        {
            "dropout_flag": dropped,
            "retention_status": F.when(dropped, rules.dropped).otherwise(rules.retained),
            "dropout_reason": F.when(dropped, reason).otherwise(rules.reason_not_applicable),
            "retention_risk_flag": dropped,
            **_updated(),
        }
    )


TRANSFORMS = {
    "students": students,
    "academic": academic,
    "attendance": attendance,
    "socio": socio,
    "retention": retention,
}


def academic_summary(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count("*").alias("records"),
        F.avg("performance_score").alias("avg_perf_score"),
        F.count_if("academic_risk_flag").alias("at_risk_students"),
    )


def retention_summary(silver: DataFrame) -> DataFrame:
    return counts_by(silver, ["retention_status"], "count", {})


def factor_count_label(
    academics: DataFrame, attendances: DataFrame, socios: DataFrame, rules: Rules = Rules()
) -> DataFrame:
    """Dropout label of the raw tables: at least three of four risk factors."""
    factors = factor_count(
        [
            F.col("avg_score") < rules.passing_score,
            F.col("attendance_pct") < rules.attendance_target,
            F.upper(F.trim("family_income_band")) == rules.low_income,
            to_boolean(F.col("working_part_time")),
        ]
    )
    joined = (
        academics.select("student_id", "avg_score")
        .join(attendances.select("student_id", "attendance_pct"), "student_id")
        .join(socios.select("student_id", "family_income_band", "working_part_time"), "student_id")
    )
    return joined.select("student_id", factors.alias("factors"), (factors >= 3).alias("dropout_flag"))
