import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scorewright.session import build_session, shared_root  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    s = build_session("local[*]", shuffle_partitions=8, extra={
        "spark.checkpoint.dir": f"file://{home}/shared", "spark.sql.warehouse.dir": f"{home}/warehouse"})
    shared_root(s)
    yield s
    s.stop()
