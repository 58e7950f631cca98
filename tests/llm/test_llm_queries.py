from __future__ import annotations

import pytest
from oracle import assert_same

from brindle.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert_same(QUERIES[name](spark, sf_dir), ORACLES[name], sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLES.keys()))
def test_one_row_for_each_input_row(spark, sf_dir, name):
    table = {"op3_url_filter": "pages", "op7_embeddings": "embeddings"}.get(name, "documents")
    out = QUERIES[name](spark, sf_dir)
    assert out.count() == spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    key = {"pages": "page_id", "embeddings": "vec_id"}.get(table, "doc_id")
    assert out.select(key).distinct().count() == out.count()
