"""Increments of promotion validity against one full run."""

import datetime as dt
import random
from unittest.mock import patch

import pytest

from ledgerlens.operators import promotion_state, promotions

START = dt.date(2022, 3, 1)


def sales(seed, n=400, days=12):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        day = rng.randrange(days)
        tokens = [f"P{rng.randrange(8)}", f"Q{rng.randrange(60)}", f" R{day}-{rng.randrange(3)} ", ""]
        out.append(dict(order_id=f"o{rng.randrange(90)}", order_date=START + dt.timedelta(day),
                        promotion_ids=",".join(rng.sample(tokens, rng.randrange(1, 5)))))
    out += [dict(order_id=None, promotion_ids="P1,P2,P3", order_date=START + dt.timedelta(k % 5))
            for k in range(3)]
    return out + [dict(order_id="o1", promotion_ids=None), dict(order_id="o2", order_date=None)]


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def same(state, whole):
    assert rows(promotion_state.qualifying_orders(state)) == rows(
        promotions.orders_with_valid_promos(whole))
    assert rows(promotion_state.valid_promotions(state)) == rows(
        promotions.valid_promotions(whole))


@pytest.mark.parametrize("order", ["forward", "backward", "mixed"])
def test_increments_equal_one_run(spark, make_sales, order):
    data = sales(7)
    days = sorted({r.get("order_date", START) or START for r in data})
    groups = [days[i::4] for i in range(4)] if order == "mixed" else [
        days[i:i + 4] for i in range(0, len(days), 4)]
    if order == "backward":
        groups = groups[::-1]
    state, so_far = promotion_state.PromotionState(), []
    for g in groups:
        batch = [r for r in data if (r.get("order_date", START) or START) in g]
        so_far += batch
        state = promotion_state.advance(state, make_sales(*batch))
        same(state, make_sales(*so_far))                # after every step


def test_lines_may_come_again(spark, make_sales):
    data = make_sales(*sales(3, 150))
    state = promotion_state.replay([data, data])
    same(state, data)
    assert state.changed_orders == 0


def test_only_touched_orders_are_counted(spark, make_sales):
    day = dt.date(2022, 5, 1)
    old = [dict(order_id=f"o{i}", promotion_ids="A,B", order_date=day) for i in range(50)]
    old += [dict(order_id=f"p{i}", promotion_ids="C", order_date=day) for i in range(50)]
    new = [dict(order_id="n", promotion_ids="C,D", order_date=day + dt.timedelta(2))]
    first = promotion_state.advance(promotion_state.PromotionState(), make_sales(*old))
    assert first.changed_orders == 0                    # no span of two days yet
    second = promotion_state.advance(first, make_sales(*new))
    assert second.changed_orders == 51                  # C's 50 orders, and the new one
    assert {r["order_id"] for r in second.counts.collect()} == {"n", *(f"p{i}" for i in range(50))}
    same(first, make_sales(*old))                       # the state before is as it was


def test_a_step_moves_old_pairs_only_where_they_count(spark, make_sales):
    """Pairs of promotions that were valid when they came, and orders that do not come again,
    are looked up no more."""
    day = [dt.date(2022, 5, 1) + dt.timedelta(k) for k in range(8)]
    lines = [make_sales(*[dict(order_id=f"{k}-{i}" if i else None, order_date=day[k + i % 3],
                               promotion_ids=f"A,B,C{i}") for i in range(60)]) for k in (0, 3)]
    names = {}

    def stored(df, name):
        names[name] = real(df, name)
        return names[name]
    real = promotion_state.stored
    first = promotion_state.advance(promotion_state.PromotionState(), lines[0])
    old = first.pairs(spark)
    assert {r["promotion_id"] for r in old.filter("valid").collect()} == {"A", "B"}
    with patch.object(promotion_state, "stored", stored):
        second = promotion_state.advance(first, lines[1])
    assert [r["order_id"] for r in names["orders-again"].collect()] == [None]
    assert names["known-pairs"].count() == 3 and old.count() == 180
    same(second, lines[0].union(lines[1]))


def test_no_lines(spark, make_sales):
    none = make_sales(dict()).limit(0)
    state = promotion_state.replay([none, make_sales(*sales(5, 60)), none])
    same(state, make_sales(*sales(5, 60)))
