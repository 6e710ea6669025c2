from conftest import d

from ledgerlens.operators import promotions as P


def _promo_rows(promo, dates, order="o1", **kw):
    return [dict(order_id=order, promotion_ids=promo, order_date=d(x), **kw) for x in dates]


def test_m11_validity_needs_two_days(make_sales):
    df = make_sales(*_promo_rows("p1", ["2022-04-01", "2022-04-02"]),
                    *_promo_rows("p2", ["2022-04-01", "2022-04-03"]))
    assert [r.promotion_id for r in P.valid_promotions(df).collect()] == ["p2"]


def test_tokens_trimmed_and_blank_ignored(make_sales):
    df = make_sales(*_promo_rows(" p1 , ,", ["2022-04-01"]), *_promo_rows("p1", ["2022-04-05"]))
    got = [(r.promotion_id, r.active_days) for r in P.valid_promotions(df).collect()]
    assert got == [("p1", 4)]


def _make_valid(make_sales, ids):
    # one helper order that makes every id valid (seen on two dates 5 days apart)
    return [dict(order_id="helper", promotion_ids=",".join(ids), order_date=d(x))
            for x in ("2022-01-01", "2022-01-06")]


def test_m12_promotions_spread_over_lines(make_sales):
    rows = _make_valid(make_sales, ["a", "b", "c"]) + [
        dict(order_id="o1", promotion_ids="a,b"), dict(order_id="o1", promotion_ids="c")]
    got = {r.order_id: r.valid_promo_count
           for r in P.orders_with_valid_promos(make_sales(*rows)).collect()}
    assert got["o1"] == 3


def test_m13_repeats_count_once(make_sales):
    rows = _make_valid(make_sales, ["a"]) + [
        dict(order_id="o1", promotion_ids="a,a"), dict(order_id="o1", promotion_ids="a")]
    got = {r.order_id for r in P.orders_with_valid_promos(make_sales(*rows)).collect()}
    assert "o1" not in got


def _base(order, amount, state="PUNJAB", city="AMRITSAR"):
    return dict(order_id=order, amount=amount, state=state, city=city, status="Cancelled",
                service_level="Standard", fulfilment="Marketplace", courier_status="Unshipped",
                promotion_ids="a,b,c")


def test_m14_m15_qualification(make_sales):
    rows = _make_valid(make_sales, ["a", "b", "c"])
    for r in rows:
        r.update(status="Pending", fulfilment="Marketplace")
    # state averages: PUNJAB 100, KERALA 50 (Merchant / Shipped lines)
    rows += [dict(order_id="m1", amount=100.0, state="punjab"),
             dict(order_id="m2", amount=50.0, state=" Kerala ")]
    rows += [_base("q1", 99.0),                      # qualifies
             _base("e1", 100.0),                     # equal to the average
             _base("n1", None),                      # null amount
             _base("x1", 1.0, state="GOA"),          # state without an average
             _base("k1", 60.0, state="KERALA", city="KOCHI")]  # above average
    rows[-1]["promotion_ids"] = "a,b,c"
    out = {r.city: r for r in P.qualification_rate(make_sales(*rows)).collect()}
    assert out["AMRITSAR"].base_count == 4 and out["AMRITSAR"].qualified_count == 1
    assert out["AMRITSAR"].pct_qualified == 25.0
    assert out["KOCHI"].qualified_count == 0 and out["KOCHI"].pct_qualified == 0.0


def test_promo_condition_required(make_sales):
    rows = [dict(order_id="m1", amount=100.0), _base("q1", 10.0)]
    rows[-1]["promotion_ids"] = "a,b,c"  # never valid: single date
    out = P.qualification_rate(make_sales(*rows)).collect()
    assert [(r.base_count, r.qualified_count) for r in out] == [(1, 0)]


def test_blank_city_not_in_base(make_sales):
    df = make_sales(_base("q1", 10.0, city=" "), _base("q2", 10.0, city=None))
    assert P.qualification_rate(df).count() == 0
