import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loamflow.session import get_spark, new_run_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    import tempfile

    s = get_spark(master="local[4]", cores=4, shuffle_partitions=8, app="loamflow-tests",
                  extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="loamflow-wh-")})
    yield s


@pytest.fixture()
def run_dir(spark):
    return new_run_dir(spark, "test")
