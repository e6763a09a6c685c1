import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "scripts"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from monthwise.session import SESSION_CONF
    b = (SparkSession.builder.master("local[*]").appName("monthwise-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests only: a local shared folder, since no cluster checkpoint dir is set
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="monthwise-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck_small():
    from compare_oracle import duck
    return duck(SF_SMALL)


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="monthwise-test-")
