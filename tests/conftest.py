import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerlake.session import get_session
    s = get_session("local[4]", app_name="ledgerlake-tests", shuffle_partitions=4,
                    **{"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ledgerlake-wh-")})
    yield s
    s.stop()
