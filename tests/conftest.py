import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sluice.session import build_session
    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
              "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    s = build_session("local[*]", app="sluice-tests", shuffle_partitions=8, extra=shared)
    yield s
    s.stop()
