import random

import pytest

from tests.llm.helpers import ODD_TEXTS, sentence


@pytest.fixture(scope="session")
def docs(spark):
    """Odd and long texts, exact and near copies, a null and repeated keys and rows, and columns with clashing names."""
    rng = random.Random(5)
    texts = [*ODD_TEXTS, *(sentence(rng, rng.randrange(3, 400)) for _ in range(60))]
    texts += [texts[30], texts[30], texts[31].replace("river", "stone", 1), texts[32] + " last", sentence(rng, 30_000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[33]), (None, None), (40, texts[40]), (40, texts[40]), (41, "other text of a known key")]
    # Names that the operators use within.
    rows = [(k, t, "clash", -1, True, "x", 0, 7) for k, t in rows]
    names = "doc_id long, text string, key string, _row long, block boolean, _text string, h long, line int"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)
