"""Streaming trailing mode equals the batch operator on every closed window."""

from conftest import SF
from pyspark.sql import functions as F

from ledgerlens.operators import trailing
from ledgerlens.sources.sales import sales_from_tables
from ledgerlens.streaming.trailing import run_available_now, trailing_mode_stream


def test_stream_matches_batch_on_closed_windows(spark, tmp_path):
    sales = sales_from_tables(spark, SF["0.001"],
                              ("order_date", "status", "size", "qty", "state"))
    lines = trailing.shipped_lines(sales)
    src = str(tmp_path / "src")
    # land the lines as files, one per year, so the stream sees several batches
    (lines.withColumn("y", F.year("day")).repartition("y").write
     .partitionBy("y").parquet(src))
    stream_in = (spark.readStream.schema("state string, day date, size string")
                 .option("maxFilesPerTrigger", 1).parquet(src + "/y=*"))
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    run_available_now(trailing_mode_stream(stream_in, watermark="1 day"), out, ckpt)
    got = spark.read.parquet(out)
    batch = trailing.trailing_mode(lines)
    assert got.count() > 0
    # every emitted window is final and equals the batch answer
    assert got.exceptAll(batch).count() == 0
    # and no closed window is missing
    last = got.agg(F.max("target_date")).first()[0]
    assert batch.filter(F.col("target_date") <= last).exceptAll(got).count() == 0


def test_stream_day_mapping_independent_of_time_zone(spark):
    from pyspark.sql import functions as F
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        df = spark.createDataFrame([("2022-04-10",)], "d string").select(
            F.to_date("d").alias("day"))
        ts = F.timestamp_seconds(F.unix_date("day").cast("bigint") * 86400)
        w = df.select(F.window(ts, "7 days", "1 day").alias("w"))
        ends = sorted(r[0] for r in w.select(F.date_from_unix_date(
            (F.unix_seconds("w.end") / 86400).cast("int"))).collect())
        assert [str(e) for e in ends] == [f"2022-04-{x}" for x in range(11, 18)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
