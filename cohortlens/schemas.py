"""Explicit schemas of the raw CSV files and of the audit log.

Columns that may arrive in more than one spelling are read wide and narrowed by
the cleaning step: the three yes/no columns of the socio-economic file as
strings, ``days_present`` as double (``120`` and ``120.0`` both occur).
"""

from __future__ import annotations

from pyspark.sql import types as T

STUDENTS = (
    "student_id string, gender string, date_of_birth date, region string, school_id string, "
    "grade_level int, enrollment_year int, program_type string"
)
ACADEMIC = (
    "student_id string, academic_year string, semester int, avg_score double, "
    "failed_subjects int, improvement_flag boolean, performance_band string"
)
ATTENDANCE = (
    "student_id string, academic_year string, total_days int, days_present double, "
    "attendance_pct double, chronic_absentee boolean, attendance_trend string"
)
SOCIO = (
    "student_id string, family_income_band string, parental_education string, "
    "access_to_internet string, working_part_time string, scholarship_status string"
)
RETENTION = (
    "student_id string, academic_year string, dropout_flag boolean, dropout_reason string, "
    "intervention_required boolean, retention_status string"
)


class RawFile:
    """One landing file: its CSV name, its schema (DDL) and its bronze/silver tables."""

    def __init__(self, csv: str, schema: str, table: str):
        self.csv = csv
        self.schema = schema
        self.bronze = f"bronze_{table}"
        self.silver = f"silver_{table}"


# File and table names.
RAW_FILES = {
    "students": RawFile("students_master.csv", STUDENTS, "students"),
    "academic": RawFile("academic_performance.csv", ACADEMIC, "academic_performance"),
    "attendance": RawFile("attendance_records.csv", ATTENDANCE, "attendance"),
    "socio": RawFile("socio_economic_data.csv", SOCIO, "socio_economic"),
    "retention": RawFile("retention_status.csv", RETENTION, "retention_status"),
}

AUDIT_LOG = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType(), False),
        T.StructField("layer_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("record_count", T.LongType(), True),
        T.StructField("run_status", T.StringType(), False),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("run_id", T.StringType(), True),
        T.StructField("attempt", T.IntegerType(), True),
    ]
)
