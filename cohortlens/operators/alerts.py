"""Alerts on predicted risk: selection, top-k, breakdowns, digest and trend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.ranges import previous, running_totals
from cohortlens.operators.rates import breakdown, counts_by, group_count, rate

# The advice lines of the digest.
ADVICE = (
    "Prioritize attendance interventions for students with attendance-related risk",
    "Initiate academic counseling for low performance groups",
    "Monitor socio-economic risk students closely",
)


def high_risk(predictions: DataFrame, threshold: float = 0.7, inclusive: bool = True) -> DataFrame:
    """Predictions at or above the threshold, or strictly above it."""
    p = F.col("dropout_probability")
    return predictions.where(p >= threshold if inclusive else p > threshold)


def stamped(alerts: DataFrame) -> DataFrame:
    return alerts.withColumn("alert_generated_timestamp", F.current_timestamp())


def by_probability(df: DataFrame) -> DataFrame:
    """Highest probability first. The id breaks ties, so a range sort can split them."""
    return df.orderBy(F.desc("dropout_probability"), "student_id")


def ranked(df: DataFrame) -> DataFrame:
    """Adds ``alert_rank``: a row's place in the order of ``by_probability``, from 1, none twice.

    NULL probabilities come last, then NULL ids. The table is cut into ranges and counted, so no
    task sorts all of it. ``student_id`` must tell rows of one probability apart, else their order
    among each other is open.
    """
    order = {"_none": F.col("dropout_probability").isNull(), "_down": -F.col("dropout_probability"), "_one": F.lit(1)}
    unnamed = F.col("student_id").isNull()
    counted = running_totals(df.withColumns({**order, "_unnamed": unnamed}), ["_none", "_down", "_unnamed", "student_id"], ["_one"])
    place = (F.col("_one_before") + 1).cast("long")
    return counted.withColumn("alert_rank", place).select(*df.columns, "alert_rank")


def top_k(alerts: DataFrame, k: int = 5) -> DataFrame:
    return by_probability(alerts.select("student_id", "dropout_probability")).limit(k)


def predictions_with_risk(predictions: DataFrame, profile: DataFrame, k: int = 20) -> DataFrame:
    """The k most at-risk students with their risk level.

    Only predictions that have a profile can be in the answer, and only the top k
    of those, so k rows are joined instead of all. The ids looked up are made
    distinct first, map-side, so that a repeated one weighs no more than another.
    """
    risk = profile.select("student_id", "risk_level", "intervention_required")
    ids = risk.select("student_id").distinct()
    known = predictions.select("student_id", "dropout_probability").join(ids, "student_id", "left_semi")
    return by_probability(risk.join(F.broadcast(by_probability(known).limit(k)), "student_id")).limit(k).select(
        "student_id", "dropout_probability", "risk_level", "intervention_required"
    )


def with_risk(alerts: DataFrame, profile: DataFrame) -> DataFrame:
    """Driver and grade of each alert's student; ``alerts`` says for how many alerts a row stands.

    Counting a student's alerts before the join keeps repeated ids from pairing up.
    """
    per_student = alerts.groupBy("student_id").agg(F.count("*").alias("alerts"))
    return profile.select("student_id", "primary_risk_driver", "grade_level").join(per_student, "student_id")


def driver_counts(alerts: DataFrame, profile: DataFrame) -> DataFrame:
    return group_count(with_risk(alerts, profile), "primary_risk_driver", "alerts")


def grade_counts(alerts: DataFrame, profile: DataFrame) -> DataFrame:
    return group_count(with_risk(alerts, profile), "grade_level", "alerts")


def driver_and_grade_counts(alerts: DataFrame, profile: DataFrame) -> DataFrame:
    """Both breakdowns from one join and one scan."""
    return breakdown(with_risk(alerts, profile), ["primary_risk_driver", "grade_level"], "alerts")


def digest(alerts: DataFrame, profile: DataFrame, k: int = 5, advice: Sequence[str] = ADVICE) -> DataFrame:
    """The alert message as rows: ``(section, rank, key, value)``.

    Sections are the total, the top students, the counts per driver and per
    grade, and the fixed advice. The ranking windows run on aggregated rows only.
    """
    order = Window.partitionBy("section").orderBy(F.desc("value"), F.asc_nulls_first("key"))
    total = alerts.agg(F.count("*").cast("double").alias("value")).select(
        F.lit("total").alias("section"), F.lit(1).alias("rank"), F.lit("high_risk_students").alias("key"), "value"
    )
    top = top_k(alerts, k).select(
        F.lit("top_students").alias("section"),
        F.col("student_id").alias("key"),
        F.col("dropout_probability").alias("value"),
    )
    groups = driver_and_grade_counts(alerts, profile).select(
        F.col("dimension").alias("section"), F.col("value").alias("key"), F.col("count").cast("double").alias("value")
    )
    ranked = top.unionByName(groups).select("section", F.row_number().over(order).alias("rank"), "key", "value")
    lines = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(line).alias("key")) for i, line in enumerate(advice, 1)])
    actions = total.select(F.inline(lines)).select(
        F.lit("recommended_actions").alias("section"), "rank", "key", F.lit(None).cast("double").alias("value")
    )
    return total.unionByName(ranked).unionByName(actions)


def institution_trend(students: DataFrame, retention: DataFrame, min_increase: float = 0.02) -> DataFrame:
    """Dropout rate of all students per enrollment year, with an alert on a rise."""
    status = retention.select("student_id", "retention_risk_flag")
    known = students.select("student_id", "enrollment_year").join(status, "student_id")
    return rate_trend(known, "enrollment_year", "retention_risk_flag", min_increase=min_increase)


def rate_trend(df: DataFrame, period: str, event: str, by: Sequence[str] = (), min_increase: float = 0.02) -> DataFrame:
    """Event rate per period, its change to the period before, and an alert on a rise.

    The periods of a group are a window over aggregated rows. Without groups the periods are
    cut into ranges, so that any number of them (one per timestamp, say) is no single task's work.
    """
    rates = counts_by(df, [*by, period], "total", {"events": F.col(event)}).withColumn("rate", rate("events", "total"))
    if by:
        order = Window.partitionBy(*by).orderBy(period)
        before = rates.withColumn("_before", F.lag("rate").over(order))
    else:
        before = previous(rates, [period], {"_before": "rate"})
    changed = before.withColumn("rate_change", F.round(F.col("rate") - F.col("_before"), 4)).drop("_before")
    return changed.withColumn("alert", F.coalesce(F.col("rate_change") >= min_increase, F.lit(False)))
