import os

import pytest

from tidemark.llm import queries
from tidemark.llm.encode import vocabulary_path

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA) or not os.path.exists(vocabulary_path()), reason="no test tables")


def test_every_document_is_answered_for(spark):
    n = spark.read.parquet(f"{DATA}/documents.parquet").count()
    ids = queries.p7_ids(spark, DATA)
    assert ids.count() == n and ids.where("ids IS NULL").count() == 0
    assert queries.p8_containers(spark, DATA).select("doc_id").distinct().count() == n
    assert queries.p8_fill(spark, DATA).first().filled > 0.9
    assert queries.p8_check(spark, DATA).first().asDict() == {"documents": n, "incomplete": 0, "cut_short": 0, "over_tokens": 0, "over_documents": 0, "over_attention": 0, "near_bound": True}
    stats = queries.p9_statistics(spark, DATA)
    assert stats.count() == n and 0.1 < queries.p9_found(spark, DATA).count() / n < 0.6
    total = ids.selectExpr("sum(size(ids)) AS n").first().n
    assert queries.p8_fill(spark, DATA).first().tokens == total
