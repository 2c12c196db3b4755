import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from deskmart.schemas import RAW_TICKETS  # noqa: E402

AS_OF = datetime(2024, 4, 1)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tickets(spark):
    """Typed raw tickets from keyword rows; absent columns are null, reopen_count is 0."""
    def make(*rows):
        names = RAW_TICKETS.names
        full = [tuple(({"reopen_count": 0, "ticket_id": str(i)} | row).get(n) for n in names)
                for i, row in enumerate(rows)]
        return spark.createDataFrame(full, RAW_TICKETS)
    return make
