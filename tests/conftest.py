import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from sievespark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", spark__sql__shuffle__partitions=4, spark__ui__showConsoleProgress="false", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
