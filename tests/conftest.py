import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidepool.session import get_session

    s = get_session("local[4]", app="tidepool-tests", shuffle_partitions=4,
                    conf={"spark.local.dir": tempfile.mkdtemp(prefix="tp-test-local-"),
                          "spark.driver.memory": "4g"})
    yield s
    s.stop()


SMALL = "/root/testdata/sf0.001"
