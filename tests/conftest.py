import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.helpers import SF_DIR  # noqa: E402
from wardstat.session import session, use_checkpoints  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    spark = session("tests", "local[4]", 4)
    spark.sparkContext.setLogLevel("ERROR")
    use_checkpoints(spark)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def features(spark, tmp_path_factory):
    """Feature rows of the smallest test tables, stored once."""
    from checks.inputs import features as derive

    path = str(tmp_path_factory.mktemp("features") / "t")
    derive(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)
