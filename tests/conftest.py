import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark():
    from compare import session

    from assetlake.session import prepare

    session = prepare(session())
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture()
def lake(spark):
    from assetlake.session import shared_dir

    return shared_dir(spark, "test")
