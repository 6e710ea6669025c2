"""Bucketed tables: the same results, without an exchange below the joins."""

import re

from conftest import SF

from ledgerlens.operators import colocated, percentiles, promotions
from ledgerlens.plans.catalog import _Q3_COLS, _Q4_COLS
from ledgerlens.sources.sales import sales_from_tables


def rows(df):
    cols = sorted(df.columns)
    return sorted(str([round(v, 6) if isinstance(v, float) else v for v in r])
                  for r in df.select(*cols).collect())


def exchanges(df):
    """The exchanges of the plan, broadcasts apart."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange ((?!Hashed)\w+\([^)]*\)|SinglePartition)", plan.split("== Initial Plan ==")[0])


def test_percentile_job(spark):
    sales = sales_from_tables(spark, SF["0.001"], _Q4_COLS)
    table = colocated.lines_by_group(sales, 8)
    got = colocated.percentile_stddev(table)
    assert exchanges(got) == []
    assert rows(got) == rows(percentiles.percentile_stddev(percentiles.promo_orders(sales)))
    assert exchanges(percentiles.percentile_stddev(percentiles.promo_orders(sales)))


def test_qualification_job(spark):
    sales = sales_from_tables(spark, SF["0.001"], _Q3_COLS)
    table = colocated.lines_by_order(sales, 8)
    got = colocated.qualification_rate(table)
    by_order = [x for x in exchanges(got) if "order_id" in x or "promotion_id" in x]
    assert by_order == []
    assert rows(got) == rows(promotions.qualification_rate(sales))
