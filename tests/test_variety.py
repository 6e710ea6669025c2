from conftest import d

from ledgerlens.operators import variety


def test_m7_small_sizes_count_too(make_sales):
    df = make_sales(dict(size="M", sku="a"), dict(size="XXL", sku="b"))
    assert [tuple(r) for r in variety.style_variety(df).collect()] == [
        ("2022-04", "PUNJAB", "ST1", 2)]


def test_m8_style_without_big_size_absent(make_sales):
    df = make_sales(dict(size="S", sku="a"), dict(size="XL", sku="b"))
    assert variety.style_variety(df).count() == 0


def test_size_is_upper_trimmed(make_sales):
    df = make_sales(dict(size=" xxl ", sku="a"))
    assert variety.style_variety(df).count() == 1


def test_m9_median_even_and_odd(make_sales):
    rows = []
    for st, n in (("A", 3), ("B", 4)):
        rows += [dict(state="KA", style=st, sku=f"{st}{i}", size="XXL") for i in range(n)]
    for st, n in (("C", 1), ("D", 2), ("E", 9)):
        rows += [dict(state="MH", style=st, sku=f"{st}{i}", size="3XL") for i in range(n)]
    got = {r.state: r.median_variety
           for r in variety.median_variety(make_sales(*rows)).collect()}
    assert got == {"KA": 3.5, "MH": 2.0}


def test_m10_months_of_different_years_stay_apart(make_sales):
    df = make_sales(dict(order_date=d("2022-04-01"), size="XXL"),
                    dict(order_date=d("2023-04-01"), size="XXL"))
    assert sorted(r.month for r in variety.median_variety(df).collect()) == [
        "2022-04", "2023-04"]


def test_invalid_lines_dropped(make_sales):
    df = make_sales(dict(size="XXL", state="NULL"), dict(size="XXL", style=" "),
                    dict(size="XXL", sku=""), dict(size="XXL", order_date=None))
    assert variety.style_variety(df).count() == 0
