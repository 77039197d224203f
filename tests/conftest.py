from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def _preset(key: str) -> bool:
    """Whether the environment's submit arguments set ``key``."""
    return key in os.environ.get("PYSPARK_SUBMIT_ARGS", "")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    builder = (SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[*]"))
               .appName("cardgeo-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC"))
    if not _preset("spark.checkpoint.dir"):  # normally named by the cluster
        builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def table_root(spark):
    from cardgeo.sinks import shared_dir
    return shared_dir(spark, "cardgeo", "tests")


def rows(df, *cols):
    """Sorted tuples of ``cols`` (all columns by default)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda t: tuple(str(x) for x in t))
