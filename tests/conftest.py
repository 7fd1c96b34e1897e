import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quietude.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="quietude-tests", shuffle_partitions=8)
    # Tests set their own checkpoint folder only because none is configured.
    if not s.conf.get("spark.checkpoint.dir", None):
        from quietude.session import ensure_checkpoint_dir
        ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="quietude-test-ckpt-"))
    yield s


@pytest.fixture(scope="module", autouse=True)
def no_cache_left():
    """What a module caches is not in the plans of the next one."""
    yield
    if session := SparkSession.getActiveSession():
        session.catalog.clearCache()


@pytest.fixture()
def tmp_out():
    return tempfile.mkdtemp(prefix="quietude-test-")
