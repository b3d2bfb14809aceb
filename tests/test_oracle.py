"""Every registered query against its SQL on DuckDB."""

import __spark_entry__ as contract
import pytest
from oracle_check import connect, differences

from tomegauge.plans import catalog, oracle

QUERIES = catalog.queries()
ORACLES = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_queries_without_the_optional_packages(monkeypatch):
    load = contract.importlib.import_module

    def missing(name, *rest):
        if name == "tomegauge.llm.catalog":
            raise ModuleNotFoundError("no such package")
        return load(name, *rest)

    monkeypatch.setattr(contract.importlib, "import_module", missing)
    assert set(contract.queries()) == set(QUERIES) and set(contract.oracle_sql()) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(name, spark, folder, connection):
    assert differences(QUERIES[name](spark, folder), connection, ORACLES[name]) == []


def test_entry_has_one_row_per_book(spark):
    result = contract.entry(spark)
    assert result.columns == ["fileName", "doc_count", "sum_multiSyllables", "smog"]
    assert result.count() == result.select("fileName").distinct().count() > 0
