import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tomegauge.session import local_session

    session = local_session(8, "tomegauge-tests", "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture(scope="session")
def sentences(spark, folder):
    from tomegauge.plans import landing
    from tomegauge.sources import tables

    return tables.read_sentences(spark, landing.sentence_store(spark, folder))


@pytest.fixture(scope="session")
def book(spark):
    """One row in, the sentence table out."""
    from tomegauge.operators.sentences import sentence_table
    from tomegauge.schemas import BOOKS

    def table(text, name="999999", **options):
        return sentence_table(spark.createDataFrame([(name, text)], BOOKS), **options)

    return table


@pytest.fixture(scope="session")
def physical():
    """The physical plan of a DataFrame as text, before anything runs."""

    def text(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    return text
