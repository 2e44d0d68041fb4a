from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from bondmart.session import SESSION_CONF, checkpoint_dir

    b = SparkSession.builder.master("local[4]").appName("bondmart-tests").config(
        "spark.sql.shuffle.partitions", "4")
    for k, v in SESSION_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="bondmart-test-")


def empty_feeds(spark, **frames):
    """Feeds with empty typed DataFrames, overridden by ``frames`` (each a
    list of dicts or a DataFrame)."""
    from pyspark.sql import types as T

    from bondmart.sources.feeds import LAYOUTS, Feeds

    out = {}
    for name in Feeds.names():
        cols = LAYOUTS[name]["columns"]
        schema = T.StructType([T.StructField(c, T._parse_datatype_string(t)) for c, t in cols])
        v = frames.get(name)
        if v is None:
            out[name] = spark.createDataFrame([], schema)
        elif isinstance(v, list):
            rows = [tuple(r.get(c) for c, _ in cols) for r in v]
            out[name] = spark.createDataFrame(rows, schema)
        else:
            out[name] = v
    return Feeds(**out)
