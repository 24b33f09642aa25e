import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hourglass.session import build_session
    wh = tempfile.mkdtemp(prefix="hg-warehouse-")
    s = build_session("local[4]", 8, app_name="hourglass-tests",
                      extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture()
def workdir(spark):
    from hourglass.session import work_dir
    return work_dir(spark, "test")
