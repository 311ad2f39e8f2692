import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from reelrank.session import get_spark
    s = get_spark("local[4]", app="reelrank-tests", shuffle_partitions=4,
                  extra={"spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    yield s
    s.stop()
