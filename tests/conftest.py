from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from auditlane.session import build_session, ensure_lake_root  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="auditlane-warehouse-")
    s = build_session(master="local[4]", app_name="auditlane-tests", shuffle_partitions=4,
                      extra_conf={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture()
def lake(spark):
    """A private lake folder per test."""
    from auditlane.sources.lake import Lake

    root = os.path.join(tempfile.mkdtemp(prefix="auditlane-test-"), "lake")
    ensure_lake_root(spark, root)
    return Lake(spark, root)
