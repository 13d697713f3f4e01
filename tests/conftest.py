import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tidepool.session import local_session, work_path  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(cores="*", shuffle_partitions=8, app="tidepool-tests")
    yield s


@pytest.fixture
def workdir(spark, request):
    return work_path(spark, request.node.name.replace("[", "-").replace("]", ""))
