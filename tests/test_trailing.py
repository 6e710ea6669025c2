from conftest import SF, d

from ledgerlens.operators import trailing
from ledgerlens.plans.catalog import QUERIES


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_m1_target_days_exclude_the_day_itself(make_sales):
    df = trailing.size_mode_by_state(make_sales(dict(order_date=d("2022-04-10"))))
    got = rows(df)
    assert [r[1] for r in got] == [d(f"2022-04-{x}") for x in range(11, 18)]
    assert all(r[0] == "PUNJAB" and r[2] == "M" and r[3] == 1 for r in got)


def test_m2_targets_cross_the_year(make_sales):
    got = rows(trailing.size_mode_by_state(make_sales(dict(order_date=d("2022-12-30")))))
    assert got[0][1] == d("2022-12-31") and got[-1][1] == d("2023-01-06")


def test_m3_tie_smallest_size_wins(make_sales):
    got = rows(trailing.size_mode_by_state(make_sales(dict(size="XL"), dict(size="L"))))
    assert {r[2] for r in got} == {"L"} and {r[3] for r in got} == {1}


def test_m4_rows_are_counted_not_quantity(make_sales):
    got = rows(trailing.size_mode_by_state(
        make_sales(dict(size="S", qty=5), dict(size="XL", qty=1), dict(size="XL", qty=1))))
    assert {(r[2], r[3]) for r in got} == {("XL", 2)}


def test_m5_state_normalisation(make_sales):
    got = rows(trailing.size_mode_by_state(make_sales(
        dict(state="punjab"), dict(state=" PUNJAB "), dict(state="NULL"),
        dict(state="null"), dict(state=""), dict(state=None))))
    assert {r[0] for r in got} == {"PUNJAB"} and {r[3] for r in got} == {2}


def test_m6_bad_quantities_and_statuses_dropped(make_sales):
    df = make_sales(dict(qty=None), dict(qty=0), dict(qty=-1), dict(status="Cancelled"),
                    dict(order_date=None), dict(size=" "))
    assert trailing.size_mode_by_state(df).count() == 0


def test_status_contains_shipped_any_case(make_sales):
    df = make_sales(dict(status="Shipped - Delivered to Buyer"), dict(status="SHIPPED"),
                    dict(status="shipped"))
    assert {r[3] for r in trailing.size_mode_by_state(df).collect()} == {3}


def test_size_case_is_kept(make_sales):
    got = rows(trailing.size_mode_by_state(make_sales(dict(size="m"), dict(size="M"))))
    assert {r[2] for r in got} == {"M"}  # 'M' < 'm', each counted once


def test_window_fn_equals_fan_out(spark):
    for sf in ("0.001", "0.01"):
        a = QUERIES["trailing_mode"](spark, SF[sf])
        b = QUERIES["trailing_mode_window_fn"](spark, SF[sf])
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_generic_keys_and_days(make_sales):
    df = make_sales(dict(order_date=d("2022-04-10"))).selectExpr(
        "state", "city", "order_date AS day", "size")
    out = trailing.trailing_mode(df, ("state", "city"), "day", "size", days=3)
    assert out.columns == ["state", "city", "target_date", "top_size", "size_count"]
    assert out.count() == 3


def test_window_fn_independent_of_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for tz in ("America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            a = QUERIES["trailing_mode"](spark, SF["0.001"])
            b = QUERIES["trailing_mode_window_fn"](spark, SF["0.001"])
            assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
