import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from threadsift.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, shuffle_partitions=4)
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("threadsift.shared.folder", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture()
def as_of():
    from pyspark.sql import functions as F

    return F.lit("2024-01-20 00:00:00").cast("timestamp")


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
