from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lexiflow.session import session

    shared = tmp_path_factory.mktemp("shared")
    s = session("tests", spark__master=f"local[{os.environ.get('LEXIFLOW_TEST_CORES', 4)}]", spark__sql__shuffle__partitions="3", spark__ui__enabled="false", spark__checkpoint__dir=f"file://{shared}", spark__driver__memory="4g", spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    s.sparkContext.setLogLevel("ERROR")
    return s
