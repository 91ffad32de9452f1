from __future__ import annotations

import pytest

from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(partitions=4)


@pytest.fixture
def partitions(spark):
    """Set the shuffle partition count for one test."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.shuffle.partitions", before)
