"""S9 over a table of token postings: the same hits as the scan, read from the query's
partitions only."""
import os

import pytest

from tideline.operators import search
from tideline.plans import params as P
from tideline.plans.queries import _searched
from conftest import SF_SMALL

DOCS = [(1, "红海行动", 3.0), (2, "看红海行动吧", 2.0), (3, "行人 don't STOP", None), (4, "red sea red", 1.0), (5, "redo", 0.5),
        (6, None, 0.1), (7, "", 0.1), (8, "x1 É_é ②", 4.0), (8, "x1 again", 4.0)]


@pytest.fixture()
def docs(spark):
    return spark.createDataFrame(DOCS, "id long, name string, score double")


@pytest.mark.parametrize("query", ["行动", "Red 行", "red sea", "é", "x1", "don t", "nothing here", "", "②"])
def test_postings_find_what_the_scan_finds(spark, docs, scratch, query):
    path = os.path.join(scratch, "p")
    search.write_postings(search.token_postings(docs, parts=8), path)
    got = search.postings_search(spark.read.parquet(path), query, parts=8).collect()
    want = search.term_match_search(docs, query).select("id", "score").distinct().collect()
    assert [r.id for r in got] == list(dict.fromkeys(r.id for r in sorted(want, key=lambda r: (r.score is None, r.score or 0, r.id))))


def test_a_search_reads_only_its_partitions(spark, scratch):
    path = os.path.join(scratch, "p")
    search.write_postings(search.token_postings(_searched(spark, SF_SMALL)), path)
    table = spark.read.parquet(path)
    hits = search.postings_search(table, P.DOC_QUERY)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") + 19:]
    assert "part" in filters[:filters.index("]")] and "EqualTo(token" in plan
    assert sorted(map(tuple, hits.collect())) == sorted(map(tuple, search.term_match_search(
        _searched(spark, SF_SMALL), P.DOC_QUERY).select("id", "score").collect()))
