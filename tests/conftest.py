import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("LEDGERLOOM_DRIVER_MEMORY", "3g")


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session, ship

    s = local_session(4, "tests")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    s.sparkContext.setLogLevel("ERROR")
    ship(s)
    yield s
    s.stop()
