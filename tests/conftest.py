import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tally.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_spark("local[*]", shuffle_partitions=8, app="tally-tests")
    # tests own their shared folder; on a cluster it comes from spark.checkpoint.dir
    if not s.conf.get("spark.checkpoint.dir", None):
        d = str(tmp_path_factory.mktemp("shared"))
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()
