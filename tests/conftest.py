import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tickvault.session import get_session
    s = get_session("tickvault-tests", "local[4]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tv-test-ckpt-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tv-test-wh-"),
    })
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tv-test-")
