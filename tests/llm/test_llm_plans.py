"""Which Python operators each query may use, in its result and in everything it writes on the way."""

import os

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from martloom.llm import queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")

PAIRS_ALL_ROWS = ("CartesianProduct", "BroadcastNestedLoopJoin")
PYTHON = ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas")
# op4, op7 and op10 run in the JVM alone; no query calls Python row by row.
ALLOWED = {
    "op1_secrets": {"ArrowEvalPython"},
    "op2_chunk_dedup": {"ArrowEvalPython"},
    "op3_graph_search": {"FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas"},
    "op5_simhash": {"ArrowEvalPython", "FlatMapGroupsInPandas"},
    "op6_pieces": {"MapInArrow"},
    "op8_quality": {"ArrowEvalPython"},
    "op9_line_crf": {"ArrowEvalPython", "FlatMapGroupsInPandas"},
    "op11_merkle": {"FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas"},
    "op12_packing": {"MapInArrow"},
    "op13_periodic_runs": {"MapInArrow"},
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_python_operators(spark, operators, monkeypatch, name):
    plans, write = [], DataFrameWriter.parquet

    def kept(self, *args, **options):
        plans.append(operators(self._df))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", kept)
    plans.append(operators(queries.QUERIES[name](spark, SF_DIR)))
    assert len(plans) > 0
    for plan in plans:
        assert {p for p in PYTHON if p in plan} <= ALLOWED.get(name, set())
        assert not any(p in plan for p in PAIRS_ALL_ROWS)
