import pytest
from check_oracle import compare, connect

import corpus_pipeline
from gridpulse.llm.common import cut, table
from gridpulse.llm.queries import REGISTRY, SQL

SF_DIR = "/root/testdata/sf0.001"


def test_stages_pass_documents_on(spark):
    docs = table(spark, SF_DIR, "documents")
    before = {r["doc_id"] for r in docs.collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = cut(stage(spark, docs, SF_DIR))
        ids = {r["doc_id"] for r in out.select("doc_id").collect()}
        assert ids <= before and ids, name
        if number < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        else:
            assert ids == before
        before, docs = ids, out


def test_registered_names():
    assert [n.split("_")[0] for n in REGISTRY] == [f"op{i}" for i in range(1, len(REGISTRY) + 1)]
    assert set(SQL) <= set(REGISTRY)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR) is None
