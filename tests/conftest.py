import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from sparktide.session import local_session
    from sparktide.workspace import release

    session = local_session(8, "sparktide-tests", **{"spark.sql.shuffle.partitions": "4"})
    yield session
    release(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return str(TESTDATA / "sf0.001")


@pytest.fixture(scope="session")
def tables(spark, folder):
    from sparktide.plans.views import Tables

    return Tables(spark, folder)


@pytest.fixture()
def work(spark):
    """A fresh path for one test."""
    from sparktide.workspace import new_path

    return new_path(spark, "test")


def same_rows(left, right):
    """Both frames hold the same rows, counting duplicates."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


@pytest.fixture(scope="session")
def assert_same():
    def check(left, right):
        assert same_rows(left, right)

    return check
