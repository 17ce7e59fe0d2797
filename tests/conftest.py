import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from gridmill.session import session

    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    made = session("local[4]", 4, spark__ui__enabled="false", spark__driver__memory="4g", spark__sql__ansi__enabled="true")
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SMALL
