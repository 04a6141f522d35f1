import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clicktide.session import RUNTIME_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("clicktide-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.checkpoint.dir", f"{folder}/shared")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.local.dir", f"{folder}/local")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def work_dir(tmp_path_factory):
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
