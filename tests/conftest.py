import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from weirgate.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    # Four cores, and a task may fail twice before its job does.
    session = local_session("4,3", 4, **{"spark.checkpoint.dir": str(folder)})
    yield session
    session.stop()


@pytest.fixture
def with_conf(spark):
    """Set session options for one test."""
    before = {}

    def apply(**options):
        for key, value in options.items():
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield lambda options: apply(**options)
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(request, with_conf):
    with_conf({"spark.sql.session.timeZone": request.param})
    return request.param


@pytest.fixture
def shuffled_joins(with_conf):
    """No broadcast joins: what a dimension or table beyond the size limit gets."""
    with_conf({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
