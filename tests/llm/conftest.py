import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture
def frame(spark):
    """Builds a DataFrame with an extra column whose name clashes with operators' own."""

    def build(rows, schema):
        return spark.createDataFrame([(*r, "other") for r in rows], schema + ", extra string")

    return build
