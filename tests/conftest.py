import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import session

    s = session("tests", "local[4]", spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_driver_memory="4g", spark_local_dir=tempfile.mkdtemp(prefix="spark-"), spark_sql_warehouse_dir=tempfile.mkdtemp(prefix="spark-"))
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
