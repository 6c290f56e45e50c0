import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from edgewatch.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(
        "tests",
        cpus=4,
        spark__sql__shuffle__partitions="4",
        spark__checkpoint__dir=f"file://{shared}",
        spark__driver__memory="4g",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    yield session
    session.stop()
