from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorflow.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # Tests run without a cluster, so they set their own checkpoint folder.
    ckpt = tempfile.mkdtemp(prefix="sf-test-ckpt-")
    s = get_session(app="sensorflow-tests", master="local[*]", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": ckpt,
                          "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sf-test-wh-"),
                          "spark.sql.streaming.stopTimeout": "30s"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, *cols, order=None):
    """Collect ``cols`` of ``df`` as plain tuples, sorted."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.select(*cols).collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)) if order is None else out
