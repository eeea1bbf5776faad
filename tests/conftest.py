from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from journeylens.runtime import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests", **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()
