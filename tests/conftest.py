import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlens.session import build_session  # noqa: E402

SALES_SCHEMA = ("order_id string, order_date date, status string, fulfilment string, "
                "courier_status string, service_level string, style string, sku string, "
                "size string, qty int, amount double, state string, city string, "
                "promotion_ids string")
DEFAULTS = dict(order_id="o1", order_date=dt.date(2022, 4, 10), status="Shipped",
                fulfilment="Merchant", courier_status="Shipped", service_level="Standard",
                style="ST1", sku="SKU1", size="M", qty=1, amount=100.0, state="PUNJAB",
                city="AMRITSAR", promotion_ids=None)
COLS = [c.split()[0] for c in SALES_SCHEMA.split(", ")]

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    return build_session("*", 8, app="ledgerlens-tests")


@pytest.fixture(scope="session")
def make_sales(spark):
    def make(*rows):
        full = [tuple({**DEFAULTS, **r}[c] for c in COLS) for r in rows]
        return spark.createDataFrame(full, SALES_SCHEMA)
    return make


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)
