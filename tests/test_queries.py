"""Every registered query against its SQL on the smallest tables, and the shape of every plan."""

import os
import re

import pytest

import __spark_entry__ as entry
from checks import harness, registry

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES  # filled by the entry module


@pytest.fixture(scope="module")
def con():
    return harness.connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, rows, note = harness.compare(spark, con, QUERIES[name], ORACLES.get(name), SF)
    assert ok, note
    assert rows > 0 or name in {"f23_secret_scan", "k5_append_only"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_plan_has_no_nested_loop(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "lang" and df.count() > 0


def test_scan_reads_only_what_it_needs(spark):
    plan = QUERIES["blocked_word_census"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string,lang:string>" in plan
