import pathlib
import sys

import pytest

ROOT = pathlib.Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from playtally.session import session  # noqa: E402

TESTDATA = pathlib.Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # Tests run on one machine, so a temporary checkpoint folder is shared by all its executors.
    built = session(
        "playtally-tests",
        spark__master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
