import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stockflow.session import build_session
    s = build_session("local[4]", 4, app_name="stockflow-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="stockflow-test-ckpt-")})
    yield s
    s.stop()
