import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tidewater.session import SCALE_CONF, SEMANTIC_CONF, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    b = SparkSession.builder.master("local[4]").appName("tidewater-tests").config("spark.sql.shuffle.partitions", "4")
    for k, v in {**SEMANTIC_CONF, **SCALE_CONF}.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s, tempfile.mkdtemp(prefix="tidewater-cp-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
