import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH")) if x)


@pytest.fixture(scope="session")
def spark():
    from holdfast.session import session

    found = session("tests", "local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "3g", "spark.ui.showConsoleProgress": "false"})
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
