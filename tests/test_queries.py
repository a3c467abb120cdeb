"""Every registered query against its SQL twin, and the shape of its plan."""

import subprocess
import sys

import pytest

import __spark_entry__ as driver
from check_queries import SAME_TYPES, compare, connect
from conftest import ROOT
from driftwise.plans import catalog

QUERIES, TWINS = catalog.load()


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(QUERIES)


def test_registry_loads_without_a_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 0"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    twin = db.sql(TWINS[name])
    assert compare((df.columns, [tuple(r) for r in df.collect()]), (twin.columns, twin.fetchall())) == ""
    types = dict(zip(twin.columns, map(str, twin.types)))
    assert {(f.dataType.simpleString(), types[f.name]) for f in df.schema.fields} <= SAME_TYPES


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(TWINS)))
def test_query_without_twin_gives_rows(spark, sf_dir, name):
    rows = QUERIES[name](spark, sf_dir).collect()
    assert rows and all(v is not None for v in rows[0])


CHEAP = sorted(set(TWINS) - {"forward_selection", "candidate_scores", "best_candidate"})


@pytest.mark.parametrize("name", CHEAP)
def test_plan_has_no_cross_join(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned_and_the_customer_partitioning_is_reused(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES["direction_label"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "l_discount" in plan and "l_quantity" not in plan and "l_extendedprice" not in plan
    # The lag and the customer join share one shuffle of the policies.
    assert plan.count("hashpartitioning(o_custkey") == 1


def test_entry_runs(spark):
    row = driver.entry(spark).first()
    assert row["n_rows"] > 0 and 0 <= row["agreement_rate"] <= 1
