"""The command-line jobs write the reports the sales jobs produce."""

from conftest import SF

from ledgerlens import jobs
from ledgerlens.plans.catalog import QUERIES
from test_sources import HEADER


def _csv(tmp_path):
    rows = [HEADER]
    for i in range(40):
        size = ["M", "L", "XXL", "3XL"][i % 4]
        promo = "p1,p2,p3" if i % 3 else ""
        rows.append(f"{i},405-{i // 2},04-{10 + i % 5:02d}-22,{'Cancelled' if i % 5 == 0 else 'Shipped'},"
                    f"Merchant,Amazon.in,Standard,ST{i % 3},SKU{i % 7},kurta,{size},B,Shipped,1,INR,"
                    f"{100 + i}.0,PUNE,{'maharashtra' if i % 2 else 'KERALA'},411001,IN,\"{promo}\",False,")
    p = tmp_path / "sales.csv"
    p.write_text("\n".join(rows) + "\n")
    return str(p)


def test_jobs_on_csv(spark, tmp_path):
    src = _csv(tmp_path)
    for name in jobs.JOBS:
        out = str(tmp_path / name)
        assert jobs.main([name, src, out], spark=spark) == out
    t = spark.read.option("header", True).csv(str(tmp_path / "trailing-mode"))
    assert t.columns == ["State", "TargetDate", "MostBoughtSize", "Count"] and t.count() > 0
    m = spark.read.option("header", True).csv(str(tmp_path / "median-variety"))
    assert m.columns == ["Month", "State", "MedianVariety"] and m.count() > 0
    q = spark.read.parquet(str(tmp_path / "qualification-rate"))
    assert q.columns == ["City", "Percentage_Qualified_Cancelled_Standard"]
    w = spark.read.parquet(str(tmp_path / "percentile-stddev"))
    assert w.columns[:3] == ["SKU", "Month", "total_orders"] and len(w.columns) == 15


def test_jobs_on_tables_match_queries(spark, tmp_path):
    out = str(tmp_path / "qr")
    jobs.main(["qualification-rate", SF["0.001"], out, "--tables"], spark=spark)
    got = spark.read.parquet(out)
    want = QUERIES["qualification_rate"](spark, SF["0.001"]).select("city", "pct_qualified")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # single key-ordered file
    files = [p for p in (tmp_path / "qr").iterdir() if p.name.startswith("part-")]
    assert len(files) == 1
    cities = [r[0] for r in got.collect()]
    assert cities == sorted(cities)
