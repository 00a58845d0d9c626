import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

CLEAN = [
    "<page><title>A</title><text>[[B]] [[C]] [[B]]</text></page>",
    "<page><title>B</title><text>[[C]]</text></page>",
    "<page><title>C</title><text>[[A]] [[C]]</text></page>",
    "<page><title>D</title><text>no links</text></page>",
    "<page><title>A</title><text>[[E]]</text></page>",
]
DIRTY = CLEAN + [
    "<page><title>F</title><text>[[]] [[A]]</text></page>",
    "[[Z]] line with no heading",
    "",
]


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("surfrank-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("OFF")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="surfrank-test-ckpt-"))
    yield s


@pytest.fixture()
def lines_df(spark):
    def make(lines):
        return spark.createDataFrame([(x,) for x in lines], "value string")

    return make


@pytest.fixture()
def scratch():
    return lambda: tempfile.mkdtemp(prefix="surfrank-test-") + "/out"
