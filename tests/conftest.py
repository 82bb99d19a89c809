import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from checks.compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(cpus=4, partitions=4)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture
def rows(spark):
    """Turns a list of tuples and a schema into a DataFrame."""
    return lambda data, schema: spark.createDataFrame(data, schema)
