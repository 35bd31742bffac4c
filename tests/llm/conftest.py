from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])


@pytest.fixture(scope="session", autouse=True)
def workers_find_the_package(spark):
    """Python workers import the package from here, wherever pytest was started."""
    paths = [ROOT, spark.sparkContext.environment.get("PYTHONPATH", "")]
    spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, paths))
    if ROOT not in sys.path:
        sys.path.insert(0, ROOT)


@pytest.fixture
def documents(spark):
    """documents with the columns of the given table and some that operators use inside."""

    def make(rows):
        schema = (
            "doc_id bigint, text string, lang string, source string, n_chars bigint,"
            " sid string, row string, n int, gram string, part string, rank string, words string"
        )
        return spark.createDataFrame(
            [(i, t, "en", None, None, "s", "r", 1, "g", "p", "k", "w") for i, t in rows], schema
        )

    return make
