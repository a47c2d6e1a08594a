import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from moodmill.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def column(spark):
    """``column(expr, texts)``: the values of a column expression over a list of texts."""
    from pyspark.sql import functions as F

    def run(change, texts):
        rows = [(i, text) for i, text in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, text string")
        return [r.v for r in df.select("i", change(F.col("text")).alias("v")).orderBy("i").collect()]

    return run
