import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_session
    s = get_session("local[4]", shuffle_partitions=4,
                    extra={"spark.local.dir": tempfile.mkdtemp(prefix="tessera-test-local-"),
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="tessera-test-wh-")})
    yield s


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
