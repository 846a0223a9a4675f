import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from spritelake.session import session

    out = session("local[4]", "tests", **{"spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.sql.shuffle.partitions": "4"})
    out.sparkContext.setLogLevel("ERROR")
    yield out
    out.stop()
