"""Every registered query against its SQL twin, on whole tables."""

import oracle
import pytest

from partflow.registry import all_queries

KNOWN = all_queries()


@pytest.fixture(scope="module")
def twin(data):
    return oracle.connect(data)


@pytest.mark.parametrize("name", sorted(KNOWN))
def test_query_equals_twin(spark, data, twin, name):
    query = KNOWN[name]
    result = query.run(spark, data)
    if query.twin():
        oracle.compare(result, query.twin(), twin)
    else:
        assert result.count() >= 0


def test_entry(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    wide = contract.entry(spark)
    assert wide.columns[:3] == ["file", "sheet", "Item Principal Cadeia"] and len(wide.columns) == 63
    assert wide.count() > 0
