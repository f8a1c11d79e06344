import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from acreage.session import build_session

    s = build_session("local[4]", 4)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
