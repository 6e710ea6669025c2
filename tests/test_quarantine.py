"""Malformed report lines are kept with reason and place; good ones are typed."""

import datetime as dt

from ledgerlens.session import scratch_path
from ledgerlens.sources import quarantine

GOOD = '1,04-30-22,Shipped,Merchant,Shipped,Standard,ST1,SKU1,M,2,406.5,PUNJAB,"A, ""B"" City","P1,P2"'


def route(spark, tmp_path, *lines, files=1):
    folder = tmp_path / "report"
    folder.mkdir()
    for i in range(files):
        part = lines[i::files]
        (folder / f"part-{i}.csv").write_text("\n".join([quarantine.HEADER, *part, ""]))
    out = scratch_path(spark, "outcomes")
    seen = quarantine.route(spark, str(folder), out)
    return seen, quarantine.good_rows(spark, out), quarantine.rejected_rows(spark, out)


def test_reasons(spark, tmp_path):
    bad = {
        GOOD.replace("04-30-22", "30.04.2022"): ["order_date"],
        GOOD.replace("04-30-22", ""): ["order_date"],
        GOOD.replace("04-30-22", "02-30-22"): ["order_date"],
        GOOD.replace(",2,", ",two,"): ["qty"],
        GOOD.replace("406.5", "n/a"): ["amount"],
        GOOD.replace("04-30-22", "x").replace(",2,", ",,").replace("406.5", "y"):
            ["order_date", "qty", "amount"],
        GOOD + ",more": ["fields"],
        "1,04-30-22,Shipped": ["fields"],
    }
    fine = [GOOD, GOOD.replace("406.5", ""), GOOD.replace('"P1,P2"', "")]
    seen, good, rejected = route(spark, tmp_path, *fine, *bad, "", files=3)
    assert {r["raw"]: r["reasons"] for r in rejected.collect()} == bad
    assert all(r["file"].endswith(".csv") and r["block"] == 0 for r in rejected.collect())
    assert len({(r["file"], r["block"], r["place"]) for r in rejected.collect()}) == len(bad)
    rows = good.collect()
    assert len(rows) == 3 and {r["amount"] for r in rows} == {406.5, None}
    assert {(r["order_date"], r["qty"], r["city"]) for r in rows} == {
        (dt.date(2022, 4, 30), 2, 'A, "B" City')}
    assert seen == {"lines": 11, "rejected": 8, "fields": 2, "order_date": 4, "qty": 2, "amount": 2}


def test_each_field_is_tried_once(spark, tmp_path):
    (tmp_path / "part-0.csv").write_text(f"{quarantine.HEADER}\n{GOOD}\n")
    rows = quarantine.judged(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("gettimestamp(") == 1 and plan.count("try_cast(") == 2
    assert rows.first()["reasons"] == []


def test_place_finds_the_line(spark, tmp_path):
    lines = [GOOD if i % 7 else f"{i},cut" for i in range(50)]
    _, _, rejected = route(spark, tmp_path, *lines)
    for r in rejected.collect():
        text = open(r["file"].removeprefix("file:")).read().splitlines()
        assert text[r["place"]] == r["raw"]


def test_only_good_only_bad_and_nothing(spark, tmp_path):
    for i, lines in enumerate(([GOOD] * 4, ["bad"] * 3, [])):
        (tmp_path / str(i)).mkdir()
        seen, good, rejected = route(spark, tmp_path / str(i), *lines)
        assert (seen["lines"], seen["rejected"]) == (len(lines), 3 if i == 1 else 0)
        assert (good.count(), rejected.count()) == (4 if i == 0 else 0, 3 if i == 1 else 0)
