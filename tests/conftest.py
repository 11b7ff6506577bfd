import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

# folder of 41 quote snapshot documents: generated, unless
# TIDEMARK_SAMPLE_SNAPSHOTS names another one of the same layout
import sample_docs  # noqa: E402

RAW_FX = os.environ.get("TIDEMARK_SAMPLE_SNAPSHOTS") or sample_docs.write()
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import checkpoint_dir, drop_scratch, get_session

    s = get_session("local[4]", app_name="tidemark-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)
    yield s
    drop_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tidemark-test-")
