import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from kardex.session import get_session
    folder = tmp_path_factory.mktemp("checkpoints")
    s = get_session("local[4]", shuffle_partitions=4, extra={"spark.checkpoint.dir": f"file://{folder}"})
    yield s
    s.stop()
