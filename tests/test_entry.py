"""Driver contract: entry() smoke, every queries() key against its DuckDB oracle."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import compare

from conftest import SF01


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["station_name", "avg_temp_c", "max_temp_c"]


def test_every_query_has_an_oracle_or_is_listed():
    no_oracle = set(E._queries()) - set(E._oracles())
    assert no_oracle == {"file_manifest", "output_listing"}
    assert set(E._oracles()) <= set(E._queries())


@pytest.mark.parametrize("key", sorted(E._queries()))
def test_query_matches_oracle(spark, key):
    res = compare(spark, SF01, [key], verbose=False)[key]
    if key in E._oracles():
        assert res["cols_match"], res
        assert res["rows"] == res["oracle_rows"], res
        assert res["hash_match"], res
    else:
        assert res["rows"] > 0


BANNED = ["CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython",
          "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"]


@pytest.mark.parametrize("key", sorted(E._queries()))
def test_plan_has_no_cross_join_or_python(spark, key):
    from conftest import SF001
    df = E._queries()[key](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BANNED if b in plan], plan
