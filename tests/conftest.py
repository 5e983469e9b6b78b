import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riverwatch import schema as S  # noqa: E402
from riverwatch.session import build_session  # noqa: E402

from samples import GOLDEN  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        app_name="riverwatch-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={"spark.default.parallelism": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):  # tests only: a local root
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rw-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def golden(spark):
    return spark.createDataFrame(GOLDEN, S.READING)
