import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.local.dir", work)
        .config("spark.sql.warehouse.dir", f"{work}/warehouse").config("spark.driver.memory", "6g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
