import os
import random

import pytest

# workers of the test session import the package from here
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame from texts; clashing extra columns included."""
    from boxwise.session import ship_package
    ship_package(spark)

    def make(texts, ids=None, langs=None):
        ids = range(len(texts)) if ids is None else ids
        langs = langs or ["en"] * len(texts)
        rows = [(i, t, g, "s", len(t or ""), "x", "y", 1.0) for i, t, g in zip(ids, texts, langs)]
        return spark.createDataFrame(rows, SCHEMA + ", digest string, node string, score double").repartition(3)
    return make


@pytest.fixture(scope="session")
def prose():
    def make(n, seed=0, words=400):
        rng = random.Random(seed)
        return " ".join(rng.choice("abcdefgh") * rng.randint(1, 3) + str(rng.randint(0, words)) for _ in range(n))
    return make
