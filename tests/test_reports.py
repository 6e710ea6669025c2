from conftest import SF
from pyspark.sql import functions as F

from ledgerlens.operators import quality as Q
from ledgerlens.operators import runs as R
from ledgerlens.sources import logs, sinks


def test_m21_only_timing_lines_parsed(spark):
    lines = ["[approx] Run 1: 2059 ms", "Warming up...", "[EXACT]  Run 1 : 2659 ms",
             "[approx] Run 2: 1137 ms", "noise [exact] Run 2: 1972 ms tail",
             "[exact] Run x: 5 ms"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = sorted(tuple(r) for r in R.parse_run_lines(df).collect())
    assert got == [("approx", 1, 2059), ("approx", 2, 1137), ("exact", 1, 2659),
                   ("exact", 2, 1972)]
    piv = R.runtime_pivot(R.parse_run_lines(df), ("approx", "exact")).orderBy("run").collect()
    assert [tuple(r) for r in piv] == [(1, 2059, 2659), (2, 1137, 1972)]
    summ = {r.method: r for r in R.runtime_summary(R.parse_run_lines(df), "approx").collect()}
    assert summ["approx"].relative_to_baseline == 1.0
    assert summ["exact"].std_ms_population == 343.5


def test_run_stats_sample_stddev(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "method string, seconds double")
    got = {r.method: r for r in R.run_stats(df).collect()}
    assert got["a"].stddev_seconds == round(2 ** 0.5, 6) and got["b"].stddev_seconds == 0.0
    assert got["a"].mean_seconds == 2.0 and got["b"].number_of_runs == 1


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 4, 10]], "x double")
    got = {r["bin"]: r["count"] for r in Q.histogram(df, "x", 5).collect()}
    assert got == {1: 2, 2: 2, 3: 1, 5: 1}
    const = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    assert [tuple(r) for r in Q.histogram(const, "x", 5).collect()] == [(1, 1.0, 1.0, 2)]


def test_heavy_groups_ordering(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 5 + [("c",)], "sku string")
    got = [tuple(r) for r in Q.heavy_groups(df, ("sku",), 2).collect()]
    assert got == [("b", 5), ("a", 3)]


def test_date_format_classes(spark):
    df = spark.createDataFrame([(x,) for x in ["04-30-22", "", None, "2022-04-30T00:00"]], "d string")
    got = {r.date_format: r.rows for r in Q.date_format_classes(df, "d").collect()}
    assert got == {"MM-DD-YY": 1, "EMPTY": 2, "OTHER:2022-04-30": 1}


def test_single_file_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(i, f"c{i % 3}") for i in range(50)], "n int, c string") \
        .groupBy("c").count()
    for fmt, writer in (("parquet", sinks.write_single_parquet), ("json", sinks.write_json),
                        ("csv", sinks.write_single_csv)):
        path = str(tmp_path / fmt)
        writer(df, path, sort_by=["c"])
        writer(df, path, sort_by=["c"])          # overwrite works
        parts = [p for p in (tmp_path / fmt).iterdir() if p.name.startswith("part-")]
        assert len(parts) == 1
        back = sinks.read_back(spark, path, fmt, "c string, count bigint")
        assert [tuple(r) for r in back.collect()] == [("c0", 17), ("c1", 17), ("c2", 16)]


def test_schema_listing(spark):
    df = spark.createDataFrame([(1, "a")], "n int, c string")
    assert [tuple(r) for r in sinks.schema_listing(spark, df).collect()] == [
        ("n", "int"), ("c", "string")]


def test_overview_and_validation_on_tables(spark):
    from ledgerlens.plans.catalog import QUERIES
    ov = QUERIES["overview"](spark, SF["0.01"]).collect()[0]
    assert ov.months == "1,2,3,4,5,6,7,8,9,10,11,12"
    assert ov.sum_total_orders_across_groups == QUERIES["promo_count"](spark, SF["0.01"]).count()


def test_number_lines_over_files_and_blocks(spark, tmp_path):
    """Files of several sizes, read in several splits each: numbers follow file and place."""
    want = []
    for name, n in (("a", 10), ("b", 4000), ("c", 50)):
        rows = [f"{name}-{i:05d}" for i in range(n)]
        (tmp_path / f"{name}.txt").write_text("".join(x + "\n" for x in rows))
        want += rows
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        lines = logs.read_log_text(spark, str(tmp_path))
        assert lines.select("file", "block").distinct().count() > 5
        got = R.number_lines(lines, [F.col("file"), F.col("block")], ["pos"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r.value for r in sorted(got, key=lambda r: r.run)] == want
    assert sorted(r.run for r in got) == list(range(1, len(want) + 1))


def test_number_lines_by_key(spark):
    df = spark.range(0, 5000, 7).select((F.col("id") * 3).alias("k")).repartition(13)
    got = R.number_lines(df, [F.floor(F.col("k") / 100)], ["k"]).collect()
    assert [r.k for r in sorted(got, key=lambda r: r.run)] == sorted(r.k for r in got)
    assert sorted(r.run for r in got) == list(range(1, len(got) + 1))


def test_pivot_takes_earliest_line_on_duplicates(spark):
    lines = [(1, "[approx] Run 1: 30 ms"), (2, "[approx] Run 1: 10 ms"), (3, "[exact] Run 1: 5 ms")]
    df = spark.createDataFrame(lines, "line long, value string")
    got = R.runtime_pivot(R.parse_run_lines(df), ("approx", "exact")).collect()
    assert [tuple(r) for r in got] == [(1, 30, 5)]


def test_single_file_is_sorted(spark, tmp_path):
    df = spark.range(3000).select(F.format_string("k%05d", (F.col("id") * 7919) % 3000).alias("k"))
    path = str(tmp_path / "out")
    sinks.write_single_csv(df.repartition(9), path, sort_by=["k"])
    part, = [p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-")]
    lines = part.read_text().split()
    assert lines[0] == "k" and lines[1:] == sorted(lines[1:]) and len(lines) == 3001


def test_validation_reports_missing_columns_and_damage(spark):
    from ledgerlens.plans.catalog import QUERIES
    wide = QUERIES["percentile_stddev"](spark, SF["0.001"])
    got = {r["check"]: r.violations for r in Q.validate_result(wide.drop("stddev_p80_exact")).collect()}
    assert got["missing_required_columns"] == 1
    assert got["stddev_p80_exact == 0 when orders_p80_exact < 2"] is None
    assert got["orders_p80_exact <= total_orders"] == 0
    row = dict(sku="a", month=1, total_orders=5)
    for m in ("approx", "exact"):
        for l in ("p80", "p90"):
            row |= {f"threshold_{l}_{m}": 2, f"orders_{l}_{m}": 3, f"stddev_{l}_{m}": 1.0}
    damage = {"duplicate_keys": {}}
    for m in ("approx", "exact"):
        damage[f"threshold_p90_{m} >= threshold_p80_{m}"] = {f"threshold_p90_{m}": 1}
        damage[f"orders_p90_{m} <= orders_p80_{m}"] = {f"orders_p90_{m}": 4}
        for l in ("p80", "p90"):
            damage[f"stddev_{l}_{m} == 0 when orders_{l}_{m} < 2"] = {
                **{f"orders_{x}_{m}": 1 for x in ("p80", "p90") if x >= l}, f"orders_{l}_{m}": 1,
                **({f"stddev_p90_{m}": 0.0} if l == "p80" else {})}
            damage[f"orders_{l}_{m} <= total_orders"] = {f"orders_p80_{m}": 6, f"orders_{l}_{m}": 6}
    cols = list(row)
    for name, change in damage.items():
        rows = [row, {**row, "sku": "b", **change}] if change else [row, row]
        df = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows],
                                   ", ".join(f"{c} {'string' if c == 'sku' else 'double' if 'std' in c else 'int'}"
                                             for c in cols))
        got = {r["check"]: r.violations for r in Q.validate_result(df).collect()}
        assert got[name] == 1, (name, got)


def test_profile_of_raw_text(spark):
    rows = [("1", "0.00", "S", "04-30-22", " a"), ("x", "abc", "", "", "b"), (None, None, None, "4/3", None),
            ("2", "0", "S", "13-45-22", "")]
    raw = spark.createDataFrame(rows, "Qty string, Amount string, SKU string, Date string, promo string")
    got = Q.profile_raw(raw, dict(qty="Qty", amount="Amount", sku="SKU", order_date="Date",
                                  promotion_ids="promo")).first().asDict()
    assert got == dict(total_rows=4, num_columns=5, empty_amount_rows=1, zero_amount_rows=2,
                       bad_amount_rows=1, empty_sku_rows=2, rows_with_promotions=2,
                       promotions_with_outer_whitespace=1, date_parse_errors=3, bad_qty_rows=2)


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "a", None), (2, "  ", 1.5), (None, "", None)],
                               "`a b` int, t string, v double")
    got = [tuple(r) for r in Q.column_profile(df).collect()]
    assert got == [(0, "a b", "int", 3, 1, 0), (1, "t", "string", 3, 0, 2), (2, "v", "double", 3, 2, 0)]
    assert [r["rows"] for r in Q.column_profile(df.limit(0)).collect()] == [0, 0, 0]
