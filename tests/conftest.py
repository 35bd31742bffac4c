from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from kinspan.session import session  # noqa: E402

DATA = Path(os.environ.get("KINSPAN_TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    spark = session(
        "kinspan-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "checkpoints"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def small_dir() -> str:
    return str(DATA / "sf0.001")


@pytest.fixture(scope="session")
def middle_dir() -> str:
    return str(DATA / "sf0.01")


@pytest.fixture
def no_broadcast(monkeypatch):
    """Make every lookup shuffle, with all keys of more than a few rows salted."""
    from kinspan.operators import skew, traversal

    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(skew, "HOT_ROWS", 3)
    monkeypatch.setattr(traversal, "GROUP_ROWS", 4)


def in_order(tuples):
    return sorted(tuples, key=lambda row: [(value is None, str(value)) for value in row])


def rows(df):
    """Rows as a sorted list of tuples."""
    return in_order(tuple(row) for row in df.collect())
