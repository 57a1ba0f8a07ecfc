"""Silver and gold transforms on rows the derived tables do not hold."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortlens.config import Rules
from cohortlens.operators.joins import hot_keys
from cohortlens.plans import gold, silver
from cohortlens.schemas import ACADEMIC, ATTENDANCE, RETENTION, SOCIO, STUDENTS


def by_id(df, *columns):
    return {r["student_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def test_students(spark):
    born = date(2004, 5, 6)
    raw = spark.createDataFrame(
        [
            (" S1 ", " Male ", born, " north ", " SCH_1", 7, 2019, " science"),
            ("S2", "F", born, "South", "SCH_2", 12, 2015, "Arts"),
            ("S3", None, born, None, None, 1, 2020, None),
            ("S4", "Male", born, "South", "SCH_2", 13, 2019, "Arts"),
            ("S5", "Male", born, "South", "SCH_2", None, 2019, "Arts"),
            ("S6", "Male", born, "South", "SCH_2", 6, 2014, "Arts"),
            ("S7", "Male", born, "South", "SCH_2", 0, None, "Arts"),
        ],
        STUDENTS,
    )
    cleaned = silver.students(raw)
    assert by_id(cleaned, "gender", "region", "school_id", "program_type", "date_of_birth") == {
        "S1": ("Male", "NORTH", "SCH_1", "SCIENCE", born),
        "S2": ("UNKNOWN", "SOUTH", "SCH_2", "ARTS", born),
        "S3": ("UNKNOWN", None, None, None, born),
    }
    assert by_id(silver.student_rejects(raw), "reject_reason") == {
        "S4": ("grade_level out of range",),
        "S5": ("grade_level out of range",),
        "S6": ("enrollment_year too early",),
        "S7": ("grade_level out of range",),
    }
    assert cleaned.where("updated_timestamp IS NULL").isEmpty()


def academic_rows(spark, scores):
    data = [(f"S{i}", "2019-20", 1, score, failed, False, "Low") for i, (score, failed) in enumerate(scores)]
    return spark.createDataFrame(data, ACADEMIC)


def test_academic_mean_counts_the_values_it_replaces(spark):
    raw = academic_rows(spark, [(None, 0), (-10.0, 1), (120.0, 7), (50.0, None), (60.0, -1), (40.0, 3)])
    mean = (-10 + 120 + 50 + 60 + 40) / 5
    got = by_id(silver.academic(raw), "avg_score", "failed_subjects", "performance_score", "academic_risk_flag")
    assert got == {
        "S0": (mean, 0, mean, False),
        "S1": (mean, 1, mean - 5, True),
        "S2": (100.0, 6, 70.0, True),
        "S3": (50.0, None, None, False),
        "S4": (60.0, 0, 60.0, False),
        "S5": (40.0, 3, 25.0, True),
    }
    valid = by_id(silver.academic(raw, Rules(mean_over="valid")), "avg_score")
    assert valid["S0"] == (50.0,)
    stale = by_id(silver.academic(raw), "improvement_flag", "performance_band")
    assert set(stale.values()) == {(False, "Low")}


def test_academic_without_any_score(spark):
    got = by_id(silver.academic(academic_rows(spark, [(None, 0), (None, 1)])), "avg_score", "academic_risk_flag")
    assert got == {"S0": (None, False), "S1": (None, False)}


def test_academic_nan_spoils_the_mean_as_in_any_average(spark):
    got = by_id(silver.academic(academic_rows(spark, [(float("nan"), 0), (None, 0), (80.0, 0)])), "avg_score")
    assert got["S0"] == (100.0,) and got["S1"][0] != got["S1"][0] and got["S2"] == (80.0,)


def test_academic_reads_its_mean_inside_the_plan(spark):
    plan = silver.academic(academic_rows(spark, [(1.0, 0)]))._jdf.queryExecution().toString()
    assert "scalar-subquery" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_attendance(spark):
    days = [(None, 180), (-5.0, 180), (200.0, 180), (100.0, 0), (100.0, -5), (200.0, None), (135.0, 180), (134.0, 180)]
    raw = spark.createDataFrame(
        [(f"S{i}", "2019-20", total, present, 150.0, True, "Stable") for i, (present, total) in enumerate(days)], ATTENDANCE
    )
    got = by_id(silver.attendance(raw), "total_days", "attendance_pct", "attendance_risk_flag", "chronic_absentee")
    assert got == {
        "S0": (180, 0.0, True, True),
        "S1": (180, 0.0, True, True),
        "S2": (180, 100.0, False, True),
        "S3": (180, 0.0, True, True),
        "S4": (180, -2.78, True, True),
        "S5": (180, 111.11, False, True),
        "S6": (180, 75.0, False, True),
        "S7": (180, 74.44, True, True),
    }


def test_socio(spark):
    raw = spark.createDataFrame(
        [
            ("S1", " low ", " Graduate ", "Yes", "False", "True"),
            ("S2", None, None, None, "Y", "no"),
            ("S3", "High", "High School", "True", "No", "maybe"),
        ],
        SOCIO,
    )
    got = by_id(
        silver.socio(raw),
        "family_income_band",
        "parental_education",
        "access_to_internet",
        "working_part_time",
        "scholarship_status",
        "socio_economic_risk_flag",
    )
    assert got == {
        "S1": ("LOW", "Graduate", True, False, True, True),
        "S2": ("UNKNOWN", None, False, True, False, True),
        "S3": ("HIGH", "High School", True, False, False, False),
    }


def test_retention(spark):
    raw = spark.createDataFrame(
        [
            ("S1", "2019-20", None, "Personal Reasons", True, "Dropped"),
            ("S2", "2019-20", True, None, False, "Retained"),
            ("S3", "2019-20", True, "Low Attendance", True, "dropped"),
            ("S4", "2019-20", False, None, None, None),
        ],
        RETENTION,
    )
    got = by_id(
        silver.retention(raw), "dropout_flag", "retention_status", "dropout_reason", "retention_risk_flag", "intervention_required"
    )
    assert got == {
        "S1": (False, "RETAINED", "N/A", False, True),
        "S2": (True, "DROPPED", "NOT REPORTED", True, False),
        "S3": (True, "DROPPED", "Low Attendance", True, True),
        "S4": (False, "RETAINED", "N/A", False, None),
    }


@pytest.fixture(scope="module")
def small_silver(spark):
    """S2 lacks all satellites, S9 has satellites but no student row."""
    students = spark.createDataFrame(
        [("S1", "Male", "NORTH", "A", 7, "ARTS"), ("S2", "Female", "NORTH", "A", 7, "ARTS")],
        "student_id string, gender string, region string, school_id string, grade_level int, program_type string",
    )
    ids = spark.createDataFrame([("S1",), ("S9",)], "student_id string")
    return {
        "students": students,
        "academic": ids.withColumns({"performance_score": F.lit(40.0), "academic_risk_flag": F.lit(True)}),
        "attendance": ids.withColumns({"attendance_pct": F.lit(70.0), "attendance_risk_flag": F.lit(True)}),
        "socio": ids.withColumns({"socio_economic_risk_flag": F.lit(False)}),
        "retention": ids.withColumns({"retention_status": F.lit("DROPPED"), "retention_risk_flag": F.lit(True)}),
    }


@pytest.mark.parametrize("split", [False, True])
def test_gold_tables(small_silver, split):
    hot = hot_keys(small_silver, "student_id", 1) if split else None
    profile = gold.student_risk_profile(small_silver, hot=hot)
    columns = ["attendance_pct", "risk_score", "risk_level", "primary_risk_driver", "intervention_required"]
    assert by_id(profile, *columns) == {
        "S1": (70.0, 70, "HIGH", "ATTENDANCE", True),
        "S2": (None, 0, "LOW", None, False),
    }
    bands = gold.attendance_vs_performance(small_silver, hot=hot)
    assert by_id(bands, "attendance_band", "performance_band", "combined_risk_flag") == {"S1": ("LOW", "LOW", True)}
    trends = [tuple(r) for r in gold.dropout_trends(small_silver, hot=hot).collect()]
    assert trends == [("NORTH", 7, 1, 1, 1.0)]
    candidates = gold.intervention_candidates(profile, small_silver["retention"], hot)
    assert by_id(candidates, "retention_status") == {"S1": ("DROPPED",)}
    assert [tuple(r) for r in gold.retention_overview(small_silver["retention"]).collect()] == [(2, 0, 2, 0.0, 1.0)]


def test_null_measures_land_in_the_top_band(spark, small_silver):
    unknown = dict(small_silver)
    unknown["academic"] = small_silver["academic"].withColumn("performance_score", F.lit(None).cast("double"))
    assert by_id(gold.attendance_vs_performance(unknown), "performance_band", "combined_risk_flag") == {"S1": ("HIGH", False)}


def test_empty_tables(spark, small_silver):
    empty = {name: df.limit(0) for name, df in small_silver.items()}
    assert gold.student_risk_profile(empty).isEmpty()
    assert [tuple(r) for r in gold.retention_overview(empty["retention"]).collect()] == [(0, 0, 0, None, None)]


def test_repeated_satellite_key_multiplies_like_a_join(small_silver):
    doubled = dict(small_silver)
    doubled["socio"] = small_silver["socio"].union(small_silver["socio"])
    assert gold.student_risk_profile(doubled).where("student_id = 'S1'").count() == 2
    assert gold.student_risk_profile(doubled, hot=hot_keys(doubled, "student_id", 1)).where("student_id = 'S1'").count() == 2
