import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from seqweave.session import checkpoint_dir

    s = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        # the 17 MB line passes in a fresh session with 1 GB; a session that has run hundreds of queries needs more
        .config("spark.driver.memory", "2g")
        .config("spark.sql.session.timeZone", "UTC")
        # what is kept of past queries fills a long session's heap
        .config("spark.sql.ui.retainedExecutions", "20")
        .config("spark.ui.retainedJobs", "50")
        .config("spark.ui.retainedStages", "50")
        .config("spark.ui.retainedTasks", "1000")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="seqweave-test-")
