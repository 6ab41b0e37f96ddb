"""Every registered query that has SQL equals it on the smallest tables."""

import pytest

from checks.compare import connect, difference
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.helpers import SF_DIR

# Trained models have no SQL; their tests are in test_models.
TRAINED = {"lr_scores", "rf_scores", "gbt_scores", "feature_importance", "batch_scores", "log_predictions"}


@pytest.fixture(scope="module")
def connection():
    with connect(SF_DIR) as opened:
        yield opened


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_its_sql(spark, connection, name):
    assert difference(spark, connection, SF_DIR, name) is None


def test_only_trained_models_lack_sql():
    assert set(QUERIES) - set(ORACLES) == TRAINED and set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 10
    assert set(entry.oracle_sql()) <= set(entry.queries())
