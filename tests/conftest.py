import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from worklens.session import tune  # noqa: E402


def new_session(folder: str = "/tmp/worklens-test") -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("worklens-tests")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        # do not record the call site of every column expression while plans are built
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = new_session(str(tmp_path_factory.mktemp("spark")))
    yield session
    session.stop()
