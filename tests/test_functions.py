"""Column rules on boundary values, NULL and NaN."""

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import cleaning as c
from cohortlens.functions import scoring as s

NAN = float("nan")


def evaluate(spark, ddl, values, column):
    """The column's value for each input row, in order."""
    data = [(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, f"i int, {ddl}")
    return [r[0] for r in df.select(column.alias("out"), "i").orderBy("i").collect()]


def test_keep_if_in(spark):
    values = ["Male", "Female", "male", "Other", "", None]
    want = ["Male", "Female", "UNKNOWN", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert evaluate(spark, "v string", values, c.keep_if_in(F.col("v"), ["Male", "Female"], "UNKNOWN")) == want


def test_upper_or(spark):
    assert evaluate(spark, "v string", [" Low", "low ", "HIGH", "", None], c.upper_or(F.col("v"), "UNKNOWN")) == [
        "LOW",
        "LOW",
        "HIGH",
        "",
        "UNKNOWN",
    ]


def test_to_boolean_strings(spark):
    true = ["true", "True", "Yes", "YES", "Y", " yes "]
    false = ["No", "false", "N", "0", "maybe", "", None, "t", "1"]
    assert evaluate(spark, "v string", true + false, c.to_boolean(F.col("v"))) == [True] * 6 + [False] * 9


def test_to_boolean_booleans(spark):
    assert evaluate(spark, "v boolean", [True, False, None], c.to_boolean(F.col("v"))) == [True, False, False]


def test_impute_or_cap(spark):
    values = [None, -10.0, -0.01, 0.0, 55.5, 100.0, 100.01, NAN]
    want = [60.0, 60.0, 60.0, 0.0, 55.5, 100.0, 100.0, 100.0]
    assert evaluate(spark, "v double", values, c.impute_or_cap(F.col("v"), F.lit(60.0), 0.0, 100.0)) == want


def test_impute_without_a_mean_stays_null(spark):
    fill = F.lit(None).cast("double")
    assert evaluate(spark, "v double", [None, -1.0], c.impute_or_cap(F.col("v"), fill, 0.0, 100.0)) == [None, None]


def test_clamp_keeps_null(spark):
    assert evaluate(spark, "v int", [None, -1, 0, 3, 6, 7], c.clamp(F.col("v"), 0, 6)) == [None, 0, 0, 3, 6, 6]


DAYS = [(None, 180), (-5, 180), (200, 180), (100, 0), (100, -5), (200, None), (90, 180)]


@pytest.mark.parametrize(
    "repair_first, want",
    [(False, [0.0, 0.0, 100.0, 0.0, -2.78, 111.11, 50.0]), (True, [0.0, 0.0, 100.0, 55.56, 55.56, 100.0, 50.0])],
)
def test_days_and_percentage(spark, repair_first, want):
    total = c.positive_or(F.col("total"), 180)
    present = c.bound_count(F.col("present"), total if repair_first else F.col("total"))
    assert evaluate(spark, "present int, total int", DAYS, c.percentage(present, total)) == want


def test_right_closed_band(spark):
    band = c.right_closed_band(F.col("v"), [0, 50, 70, 100], ["Low", "Medium", "High"])
    values = [None, 0.0, 0.01, 50.0, 50.01, 70.0, 70.01, 100.0, 100.01]
    assert evaluate(spark, "v double", values, band) == [None, None, "Low", "Low", "Medium", "Medium", "High", "High", None]


def test_band_below(spark):
    attendance = s.band_below(F.col("v"), [(60.0, "VERY LOW"), (75.0, "LOW"), (90.0, "MEDIUM")], "HIGH")
    values = [59.99, 60.0, 74.99, 75.0, 89.99, 90.0, None]
    assert evaluate(spark, "v double", values, attendance) == ["VERY LOW", "LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH"]


FLAGS = "academic boolean, attendance boolean, socio boolean"
POINTS = [("academic", 30), ("attendance", 40), ("socio", 30)]
LABELS = [("academic", "ACADEMIC"), ("attendance", "ATTENDANCE"), ("socio", "SOCIO_ECONOMIC")]
COMBINATIONS = [
    # academic, attendance, socio -> score, level, driver, driver by weight
    ((False, False, False), 0, "LOW", None, None),
    ((True, False, False), 30, "LOW", "ACADEMIC", "ACADEMIC"),
    ((False, True, False), 40, "MEDIUM", "ATTENDANCE", "ATTENDANCE"),
    ((False, False, True), 30, "LOW", "SOCIO_ECONOMIC", "SOCIO_ECONOMIC"),
    ((True, True, False), 70, "HIGH", "ATTENDANCE", "ATTENDANCE"),
    ((True, False, True), 60, "MEDIUM", "SOCIO_ECONOMIC", "ACADEMIC"),
    ((False, True, True), 70, "HIGH", "SOCIO_ECONOMIC", "ATTENDANCE"),
    ((True, True, True), 100, "HIGH", "SOCIO_ECONOMIC", "ATTENDANCE"),
    ((None, None, None), 0, "LOW", None, None),
    ((None, True, None), 40, "MEDIUM", "ATTENDANCE", "ATTENDANCE"),
]


def test_score_level_and_driver(spark):
    flags = [x[0] for x in COMBINATIONS]
    points = s.weighted_points(POINTS)
    assert evaluate(spark, FLAGS, flags, points) == [x[1] for x in COMBINATIONS]
    assert evaluate(spark, FLAGS, flags, s.score_level(points, 70, 40)) == [x[2] for x in COMBINATIONS]
    assert evaluate(spark, FLAGS, flags, s.last_label(LABELS)) == [x[3] for x in COMBINATIONS]
    by_weight = [LABELS[1], LABELS[0], LABELS[2]]
    assert evaluate(spark, FLAGS, flags, s.first_label_by_priority(by_weight)) == [x[4] for x in COMBINATIONS]


def test_factor_count_ignores_unknown(spark):
    count = s.factor_count([F.col("academic"), F.col("attendance"), F.col("socio")])
    assert evaluate(spark, FLAGS, [(True, None, True), (None, None, None)], count) == [2, 0]
