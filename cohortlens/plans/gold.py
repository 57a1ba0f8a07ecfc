"""Gold layer: risk profile, bands, trends, intervention list and overview."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.config import Rules
from cohortlens.functions.cleaning import is_true
from cohortlens.functions.scoring import band_below, last_label, score_level, weighted_points
from cohortlens.operators.joins import pairs_of, split_star_join, star_join
from cohortlens.operators.rates import counts_by, rate

KEY = "student_id"
# The output columns of the tables.
STUDENT_COLUMNS = [KEY, "gender", "region", "school_id", "grade_level", "program_type"]
ACADEMIC_COLUMNS = [KEY, "performance_score", "academic_risk_flag"]
ATTENDANCE_COLUMNS = [KEY, "attendance_pct", "attendance_risk_flag"]
SOCIO_COLUMNS = [KEY, "socio_economic_risk_flag"]
RETENTION_COLUMNS = [KEY, "retention_status", "retention_risk_flag"]


def _join(tables: dict[str, DataFrame], how: str, hot: DataFrame | None) -> DataFrame:
    """First table with the others; ``hot`` (from ``hot_keys``) splits its keys over tasks."""
    if hot is None:
        spine, *satellites = tables.values()
        return star_join(spine, satellites, KEY, how)
    return split_star_join(tables, KEY, how, hot)


def joined_flags(silver: dict[str, DataFrame], hot: DataFrame | None = None) -> DataFrame:
    """Every student with the measures and flags of the four other tables."""
    tables = {
        "students": silver["students"].select(*STUDENT_COLUMNS),
        "academic": silver["academic"].select(*ACADEMIC_COLUMNS),
        "attendance": silver["attendance"].select(*ATTENDANCE_COLUMNS),
        "socio": silver["socio"].select(*SOCIO_COLUMNS),
        "retention": silver["retention"].select(*RETENTION_COLUMNS),
    }
    return _join(tables, "left", hot)


def with_risk(flags: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Score, level, driver and intervention flag from the three risk flags."""
    score = F.col("risk_score")
    return (
        flags.withColumns(
            {"risk_score": weighted_points(rules.flag_points), "primary_risk_driver": last_label(rules.flag_labels)}
        )
        .withColumn("risk_level", score_level(score, rules.high_score, rules.medium_score))
        .withColumn("intervention_required", F.col("risk_level") == "HIGH")
    )


def student_risk_profile(
    silver: dict[str, DataFrame], rules: Rules = Rules(), hot: DataFrame | None = None
) -> DataFrame:
    flags = joined_flags(silver, hot)
    added = ["risk_score", "risk_level", "primary_risk_driver", "intervention_required"]
    return with_risk(flags, rules).select(*flags.columns, *added)


def attendance_vs_performance(
    silver: dict[str, DataFrame], rules: Rules = Rules(), hot: DataFrame | None = None
) -> DataFrame:
    tables = {
        "students": silver["students"].select(*STUDENT_COLUMNS),
        "attendance": silver["attendance"].select(*ATTENDANCE_COLUMNS),
        "academic": silver["academic"].select(*ACADEMIC_COLUMNS),
    }
    weak = F.col("attendance_band").isin(*rules.weak_attendance_bands) & (
        F.col("performance_band") == rules.weak_performance_band
    )
    return _join(tables, "inner", hot).withColumns(
        {
            "attendance_band": band_below(F.col("attendance_pct"), rules.attendance_bands, rules.top_band),
            "performance_band": band_below(F.col("performance_score"), rules.performance_bands, rules.top_band),
        }
    ).withColumn("combined_risk_flag", is_true(weak))


def dropout_trends(silver: dict[str, DataFrame], rules: Rules = Rules(), hot: DataFrame | None = None) -> DataFrame:
    tables = {
        "students": silver["students"].select(KEY, "region", "grade_level"),
        "retention": silver["retention"].select(KEY, "retention_status"),
    }
    joined = _join(tables, "inner", hot)
    dropped = {"dropped_students": F.col("retention_status") == rules.dropped}
    counts = counts_by(joined, ["region", "grade_level"], "total_students", dropped)
    return counts.withColumn("dropout_rate", rate("dropped_students", "total_students"))


def intervention_candidates(profile: DataFrame, retention: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Students who need intervention, including those already dropped."""
    chosen = profile.where("intervention_required").select(
        KEY, "grade_level", "region", "risk_score", "risk_level", "primary_risk_driver", "intervention_required"
    )
    if hot is not None:  # the profile holds a key as often as all its tables together make it
        tables = [t for t in hot.columns if t not in (KEY, "_rows")]
        hot = hot.withColumn("profile", pairs_of(tables))
    return _join({"profile": chosen, "retention": retention.select(KEY, "retention_status")}, "inner", hot)


def retention_overview(retention: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row over all retention records, also those of rejected students."""
    status = F.col("retention_status")
    conditions = {"retained_students": status == rules.retained, "dropped_students": status == rules.dropped}
    return counts_by(retention, [], "total_students", conditions).withColumns(
        {
            "retention_rate": rate("retained_students", "total_students"),
            "dropout_rate": rate("dropped_students", "total_students"),
        }
    )


def preview(df: DataFrame, columns: list[str], k: int) -> DataFrame:
    """First k rows by student id, so that a preview is the same every time."""
    return df.select(*columns).orderBy(KEY).limit(k)
