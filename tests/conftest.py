from __future__ import annotations

import os

import pytest
from pyspark.sql import SparkSession

from sluice.session import build_session, shared_dir


def make_session() -> SparkSession:
    spark = build_session(
        "sluice-tests",
        f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": "/tmp/sluice-warehouse",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    shared_dir(session)
    return session


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return "/root/testdata/sf0.001"
