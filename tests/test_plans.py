"""Plan-shape checks for the properties that matter at scale.

* Aggregation-only operators (trailing mode, median variety, percentile
  stddev): every exchange is fed by an aggregate, i.e. lines are combined
  map-side before any shuffle, so a hot key ships one partial row per task.
* Percentile stddev never joins the thresholds back to the lines.
* Scans read only the columns the query needs and get the filters pushed.
"""

import re

import pytest
from conftest import SF

from ledgerlens.plans.catalog import QUERIES


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(plan):
    # strip tree-drawing characters, keep operator names in order
    return [re.sub(r"^[\s:|+\-]*", "", ln) for ln in plan.splitlines() if ln.strip()]


def _exchange_children(plan):
    ops = _lines(plan)
    out = []
    for i, op in enumerate(ops):
        if op.startswith("Exchange hashpartitioning") or op.startswith("Exchange rangepartitioning"):
            nxt = next((o for o in ops[i + 1:] if not o.startswith("*")
                        and not o.startswith("Project") and not o.startswith("Filter")
                        and not o.startswith("Sort ")), None)
            if nxt is None:
                nxt = ops[i + 1] if i + 1 < len(ops) else ""
            out.append(nxt)
    return out


@pytest.mark.parametrize("name", ["trailing_mode", "median_variety", "style_variety",
                                  "percentile_stddev", "threshold_exact", "threshold_approx"])
def test_every_exchange_is_combined_map_side(spark, name):
    plan = _plan(QUERIES[name](spark, SF["0.01"]))
    kids = _exchange_children(plan)
    assert kids, plan
    for k in kids:
        k = k.lstrip("*() 0123456789")
        assert "Aggregate" in k or k.startswith("Window") or k.startswith("Union"), (k, plan)


def test_percentile_stddev_does_not_join_lines_back(spark):
    plan = _plan(QUERIES["percentile_stddev"](spark, SF["0.01"]))
    # the only join above the aggregations is thresholds x frequency table;
    # the line-level joins are the sales mapping (lineitem x orders)
    joins = [ln for ln in _lines(plan) if "Join" in ln and "l_orderkey" not in ln]
    assert len(joins) == 1, joins
    assert "_key" in joins[0]


@pytest.mark.parametrize("name,allowed", [
    ("percentile_stddev", {"l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice",
                           "l_discount", "l_tax", "o_orderkey", "o_orderdate"}),
    ("trailing_mode", {"l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_linestatus",
                       "o_orderkey", "o_custkey", "o_orderdate", "c_custkey", "c_nationkey",
                       "n_nationkey", "n_name", "p_partkey", "p_size"}),
])
def test_scans_are_pruned(spark, name, allowed):
    plan = _plan(QUERIES[name](spark, SF["0.01"]))
    read = set()
    for m in re.finditer(r"FileScan parquet \[([^\]]*)\]", plan):
        read |= {f.split("#")[0].strip() for f in m.group(1).split(",")}
    assert read and read <= allowed, read - allowed


def _large(spark, name):
    """The plan where no table is small enough to be broadcast."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _plan(QUERIES[name](spark, SF["0.01"]))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name, scans", [
    ("overview", 1), ("profile_summary", 1), ("largest_groups", 1),
    ("zero_breakdown", 2), ("qualification_rate", 4)])
def test_fact_scans_of_large_plans(spark, name, scans):
    # scans as planned; equal exchanges are shared when the plan runs
    plan = _large(spark, name)
    assert "BroadcastHashJoin" not in plan
    found = [x for x in re.findall(r"Location: [^\n]*", plan) if "lineitem.parquet" in x]
    assert len(found) <= scans, found


def test_profile_does_not_join_what_it_does_not_read(spark):
    plan = _large(spark, "profile_summary")
    assert "customer.parquet" not in plan and "part.parquet" not in plan


def test_filters_reach_the_scan(spark):
    plan = _plan(QUERIES["qualification_rate"](spark, SF["0.01"]))
    pushed = re.findall(r"PushedFilters: \[([^\n]*)\]", plan)
    assert any("IsNotNull(l_orderkey)" in p for p in pushed)
    # the status rule is evaluated on the scan's output, before any exchange
    assert re.search(r"Filter [^\n]*l_returnflag", plan)
