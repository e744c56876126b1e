import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
DATA = os.environ.get("EDICTA_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from edicta.session import discard, local_session

    s = local_session("*", 8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    discard(s)


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"
