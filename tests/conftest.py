import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pillbox.session import get_session

    spark = get_session("local[4]", app="pillbox-tests", shuffle_partitions=8)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pillbox-test-ckpt-"))
    yield spark


@pytest.fixture()
def tmp_dir(spark):
    from pillbox.session import scratch_path

    return scratch_path(spark, "test")
