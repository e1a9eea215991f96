"""The registered queries against their SQL twins, on whole tables."""

import oracle
import pytest
from partflow.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_twin(spark, data, name):
    oracle.compare(queries.queries()[name](spark, data), queries.oracle_sql()[name], oracle.connect(data))
