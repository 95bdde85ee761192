import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from skein.session import ENGINE_CONF
    b = (SparkSession.builder.master("local[*]").appName("skein-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.default.parallelism", "8"))
    for k, v in ENGINE_CONF.items():
        b = b.config(k, v)
    # Tests own their scratch folder; on a cluster the session names it.
    b = b.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="skein-test-ckpt-"))
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="skein-test-")
