import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.oracle import database, session  # noqa: E402

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def duck():
    return database(FOLDER)
