import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparklab.session import get_session

    s = get_session("local[8]", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="sparklab-wh-")})
    yield s


@pytest.fixture(scope="session")
def duck():
    from sparklab.plans.compare import duckdb_connection

    return duckdb_connection(SF001)


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="sparklab-test-")
