"""Every registered query against its SQL, and what no plan may contain."""

import pytest
from compare import compare, connect

from catalog import oracles, queries

SF = "/root/testdata/sf0.001"
QUERIES, SQL = queries.queries(), oracles.oracle_sql()
# walks documents to any depth, which no fixed set of expressions does
WALKS = {"schema_drift_events"}

# Python in a plan, or a join of every row with every other
FORBIDDEN = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "PythonUDF",
    "InPandas",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
)


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SQL[name], SF) is None


@pytest.mark.parametrize("name", QUERIES)
def test_plan_stays_in_the_engine(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [word for word in FORBIDDEN if word in plan]
    assert ("InArrow" in plan) == (name in WALKS)


def scans(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().count("FileScan")


def test_drift_and_orphans_read_each_table_once(spark):
    assert scans(spark, "schema_drift_events") == 1
    # orders, lineitem, events as reviews and as deliveries, customer with nation, part
    assert scans(spark, "join_orphans") == 7
    plan = QUERIES["join_orphans"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Join") <= plan.count("nation")


def test_entry(spark):
    import __spark_entry__ as entry

    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())
    orders = entry.entry(spark)
    assert len(orders.columns) == 34 and orders.count() > 0


def test_flagship_reads_each_table_once(spark):
    plan = QUERIES["customer_order_360"](spark, SF)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    # orders, customer + nation, lineitem, part, events as reviews and as deliveries
    assert text.count("FileScan") == 7
