import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from lectern.session import session

    s = session("local[4]", 4, spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="3g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
