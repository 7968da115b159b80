import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from probity.session import get_session
    s = get_session("local[4]", "probity-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        # tests only: the cluster would name a shared folder here
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()
