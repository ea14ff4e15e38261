import pytest
from compare import connect, differences

from tillwise.llm import workload

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(workload.oracle_sql()))
def test_matches_sql(spark, name):
    assert differences(workload.queries()[name](spark, SF), connect(SF), workload.oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(workload.queries()) - set(workload.oracle_sql())))
def test_gives_a_row_per_document(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    got = workload.queries()[name](spark, SF).select("doc_id").collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in docs)


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in workload.queries()) == list(range(1, 14))
