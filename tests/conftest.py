import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from shoplens.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4,
                      extra={"spark.driver.memory": "4g"})
    yield s
