import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidegate.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="tidegate-tests-"),
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def runs_python(plan):
    return any(mark in plan for mark in ("EvalPython", "PythonUDF", "InPandas", "InArrow"))
