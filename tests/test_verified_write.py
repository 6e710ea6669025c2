"""An output is replaced only by what reads back as it was written."""

import os

import pytest

from ledgerlens.session import scratch_path
from ledgerlens.sources import sinks


def rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def frame(spark, n=50):
    return spark.createDataFrame([(i, i / 7, f"t{i}" if i % 5 else None) for i in range(n)],
                                 "a long, b double, c string").repartition(4)


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_overwrite(spark, fmt):
    path = scratch_path(spark, "verified")
    sinks.write_verified(frame(spark, 3), path, fmt)
    found = sinks.write_verified(frame(spark), path, fmt)
    assert found["rows_written"] == found["rows_read"] == 50
    assert found["checksum_written"] == found["checksum_read"] != "0"
    assert rows(spark.read.schema(frame(spark).schema).format(fmt).load(path)) == rows(frame(spark))
    folder = os.path.dirname(path.removeprefix("file://").removeprefix("file:"))
    assert [x for x in os.listdir(folder) if x.startswith(os.path.basename(path))] == [
        os.path.basename(path)]


def test_a_spoilt_write_leaves_the_old_output(spark):
    """CSV reads an empty text back as a null: not what was written."""
    path = scratch_path(spark, "verified")
    old = spark.createDataFrame([("x",), ("y",)], "c string")
    sinks.write_verified(old, path, "csv")
    bad = spark.createDataFrame([("",), ("z",)], "c string")
    with pytest.raises(sinks.SpoiltWrite, match="rows_read"):
        sinks.write_verified(bad, path, "csv")
    assert rows(spark.read.schema("c string").csv(path)) == rows(old)
    folder = os.path.dirname(path.removeprefix("file://").removeprefix("file:"))
    assert len([x for x in os.listdir(folder) if x.startswith(os.path.basename(path))]) == 1


def test_lost_rows_are_seen(spark, monkeypatch):
    path = scratch_path(spark, "verified")
    sinks.write_verified(frame(spark, 4), path)
    sums = sinks.row_sums
    calls = []

    def fewer(df):                      # a file that vanishes between write and read
        if calls:
            folder = df.inputFiles()[0].removeprefix("file://")
            os.unlink(folder)
        calls.append(1)
        return sums(df)
    monkeypatch.setattr(sinks, "row_sums", fewer)
    with pytest.raises(Exception):
        sinks.write_verified(frame(spark), path)
    monkeypatch.undo()
    assert rows(spark.read.parquet(path)) == rows(frame(spark, 4))


def test_sums_do_not_depend_on_order(spark):
    a, b = (frame(spark).repartition(n).agg(*sinks.row_sums(frame(spark))).first() for n in (1, 7))
    assert tuple(a) == tuple(b)
    other = frame(spark).selectExpr("a", "b", "coalesce(c, '') AS c")
    assert other.agg(*sinks.row_sums(other)).first()["checksum"] != a["checksum"]


def test_no_rows(spark):
    path = scratch_path(spark, "verified")
    found = sinks.write_verified(frame(spark).limit(0), path)
    assert found == {"rows_written": 0, "checksum_written": "0", "rows_read": 0, "checksum_read": "0"}
