from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from rallymart.sources.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        configure(SparkSession.builder.master("local[8]").appName("tests"))
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield session
    session.stop()


@pytest.fixture
def hot_limit(spark, monkeypatch):
    """Lowers the size from which a group counts as hot."""
    from rallymart.operators import ranking
    from rallymart.operators.ranking import HOT_ROWS_SETTING

    monkeypatch.setattr(ranking, "MOST_BLOCKS", 12)

    def set_limit(rows: int) -> None:
        spark.conf.set(HOT_ROWS_SETTING, str(rows))

    yield set_limit
    spark.conf.unset(HOT_ROWS_SETTING)
