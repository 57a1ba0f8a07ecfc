"""Cohort-risk analytics as plain DataFrame-to-DataFrame functions on Spark."""

from cohortlens.config import PipelineConfig, Rules

__all__ = ["PipelineConfig", "Rules"]
