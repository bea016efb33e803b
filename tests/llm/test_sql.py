import pytest

from keelson.llm.queries import LLM_QUERIES
from oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", [k for k, (_, sql) in LLM_QUERIES.items() if sql])
def test_query_matches_its_sql(spark, key):
    fn, sql = LLM_QUERIES[key]
    ok, said = compare(fn(spark, SF).toPandas(), duck(SF).sql(sql).df())
    assert ok, said
