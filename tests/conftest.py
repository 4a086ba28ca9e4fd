import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skein.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ck = tempfile.mkdtemp(prefix="skein-test-ck-")
    s = build_session(master="local[4]", **{"spark.checkpoint.dir": ck, "spark.sql.shuffle.partitions": "4"})
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="skein-test-")
