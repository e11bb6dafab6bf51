"""The registered queries against their SQL counterparts."""

import pytest
from compare import connect, differences

from tidemark.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, duck, folder, name):
    assert differences(QUERIES[name](spark, folder), duck, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_one_row_per_row(spark, folder, name):
    """Each query returns every id of its whole table."""
    tables = {"op3": ("pages", "page_id"), "op4": ("pages", "page_id"), "op11": ("embeddings", "vec_id")}
    table, key = tables.get(name.split("_")[0], ("documents", "doc_id"))
    wanted = {r[0] for r in spark.read.parquet(f"{folder}/{table}.parquet").select(key).collect()}
    rows = [r[0] for r in QUERIES[name](spark, folder).select(key).collect()]
    assert set(rows) == wanted and (len(rows) == len(wanted) or name in ("op2_packing", "op11_whitening"))
