import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from channelmart.session import local_session
    s = local_session(cores="*", shuffle_partitions=8, app="channelmart-tests")
    yield s


@pytest.fixture()
def scratch(tmp_path_factory):
    return str(tmp_path_factory.mktemp("cm"))
