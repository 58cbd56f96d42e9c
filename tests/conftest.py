from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from plumbline.session import recommended  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        recommended(SparkSession.builder.master("local[4]"))
        .appName("plumbline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def workspace(spark):
    from plumbline.sources.workspace import Workspace

    with Workspace(spark) as ws:
        yield ws
