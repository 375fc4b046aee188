import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[4]", shuffle_partitions=8, app_name="tillroll-tests")
    # tests own the checkpoint folder (on a cluster it comes from the session)
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture
def write_text(tmp_path):
    """Write lines to a fresh text file and return its path."""
    counter = {"n": 0}

    def _write(lines: str) -> str:
        counter["n"] += 1
        p = tmp_path / f"in{counter['n']}.txt"
        p.write_text(lines)
        return str(p)

    return _write
