import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from retailflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("retailflow-tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": "/tmp/retailflow-warehouse"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df, *sort):
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)) if not sort else out
