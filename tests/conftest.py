import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from varzea.session import get_session
    wh = tempfile.mkdtemp(prefix="varzea-wh-")
    s = get_session("local[4]", app="varzea-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lake(spark):
    from varzea.sources.fixtures import Lake
    return Lake(spark, SF_SMOKE)


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
