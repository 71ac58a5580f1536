import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from profitlens.session import drop_staged, local_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(str(tmp_path_factory.mktemp("shared")), 4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
