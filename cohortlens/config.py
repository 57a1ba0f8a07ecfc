"""Business rules and run settings.

Every threshold, weight, band and word list a transform uses sits here, so a
different cohort (customers, members, patients) is a different ``Rules`` value
and not a code change.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Rules:
    # Results depend on every one of them.
    unknown: str = "UNKNOWN"
    genders: tuple[str, ...] = ("Male", "Female")
    grade_range: tuple[int, int] = (1, 12)
    first_enrollment_year: int = 2015

    score_range: tuple[float, float] = (0.0, 100.0)
    failed_range: tuple[int, int] = (0, 6)
    points_per_failure: int = 5
    passing_score: float = 50.0
    failed_limit: int = 3

    default_school_days: int = 180
    attendance_target: float = 75.0

    low_income: str = "LOW"

    dropped: str = "DROPPED"
    retained: str = "RETAINED"
    reason_missing: str = "NOT REPORTED"
    reason_not_applicable: str = "N/A"

    flag_points: tuple[tuple[str, int], ...] = (
        ("academic_risk_flag", 30),
        ("attendance_risk_flag", 40),
        ("socio_economic_risk_flag", 30),
    )
    flag_labels: tuple[tuple[str, str], ...] = (
        ("academic_risk_flag", "ACADEMIC"),
        ("attendance_risk_flag", "ATTENDANCE"),
        ("socio_economic_risk_flag", "SOCIO_ECONOMIC"),
    )
    high_score: int = 70
    medium_score: int = 40

    attendance_bands: tuple[tuple[float, str], ...] = (
        (60.0, "VERY LOW"),
        (75.0, "LOW"),
        (90.0, "MEDIUM"),
    )
    performance_bands: tuple[tuple[float, str], ...] = ((50.0, "LOW"), (70.0, "MEDIUM"))
    top_band: str = "HIGH"
    weak_attendance_bands: tuple[str, ...] = ("VERY LOW", "LOW")
    weak_performance_band: str = "LOW"

    alert_probability: float = 0.7
    alert_top_k: int = 5
    walkthrough_top_k: int = 20
    trend_min_increase: float = 0.02

    # Two switches whose defaults give the established results.
    mean_over: str = "all"  # "valid": leave out-of-range scores out of the mean
    repair_denominator_first: bool = False  # fix total_days before bounding days_present


@dataclass(frozen=True)
class PipelineConfig:
    database: str = "cohort_risk"
    pipeline_name: str = "cohort_risk_pipeline"
    source_system: str = "synthetic_csv"
    table_format: str = "parquet"  # "delta" where the session has it
    write_options: dict[str, str] = field(default_factory=dict)
    infer_schema: bool = False
    csv_options: dict[str, str] = field(default_factory=dict)  # such as nullValue, dateFormat, mode
    # "null": a value of another type is NULL and its record stays; "quarantine": the record goes
    # to bronze_rejects.
    on_malformed: str = "null"
    rules: Rules = Rules()

    # Keys with more rows than this in a table, or pairs in a join, are split over several tasks.
    hot_key_rows: int = 1_000_000
    # Silver tables are written in this many buckets by key, but for those with a hot key.
    # Gold joins of bucketed tables need no exchange. Needs a format with buckets.
    silver_buckets: int | None = None
    # "multiply": repeated satellite keys multiply rows, as an SQL join does.
    # "fail": stop before the join and name the table.
    on_repeated_key: str = "fail"

    train_fraction: float = 0.8
    seed: int = 42
    split: str = "hash"  # "random": DataFrame.randomSplit
    score_on: str = "test"  # "all": score every student

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"
