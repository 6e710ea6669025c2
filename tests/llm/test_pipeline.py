"""Every stage takes effect on what its predecessor kept; the whole run adds up."""

import random

import corpus_pipeline as P
import pytest
from helpers import awkward, empty, sentence
from test_packing import check_layout

SF = "/root/testdata/sf0.01"


def test_names_and_order():
    assert [n for n, _ in P.STAGES] == [
        "quality_rules", "quality_classifier", "line_dedup", "minhash_near_dedup",
        "best_fit_packing"]
    assert P.ORACLE_SQL is None


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before each stage, and the result of the last."""
    from ledgerlens.llm.scratch import stored
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in P.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def test_columns_and_rows(stages):
    for before, after in zip(stages[:-1], stages[1:-1]):
        assert after.columns == before.columns
        ids, left = ([r[0] for r in x.select("doc_id").collect()] for x in (before, after))
        assert len(left) == len(set(left)) and set(left) <= set(ids)
    assert 0 < stages[4].count() < stages[0].count()
    assert stages[4].filter("n_chars <> length(text)").count() == 0


def test_filters_match_their_operators(stages):
    import duckdb

    from ledgerlens.llm import line_frequency
    kept = {r[0] for r in line_frequency.judge(stages[0]).filter("kept").select("doc_id").collect()}
    assert {r[0] for r in stages[1].select("doc_id").collect()} == kept
    labels = {i: (q, t) for i, q, t in
              duckdb.sql(f"SELECT doc_id, quality, toxic FROM '{SF}/labels.parquet'").fetchall()}
    left = {r[0] for r in stages[2].select("doc_id").collect()}
    good = [i for i in kept if labels.get(i) == (1, 0)]
    assert sum(i in left for i in good) >= 0.97 * len(good)


def test_no_near_duplicates_are_left(stages):
    from test_near_dup import brute
    rows = [tuple(r) for r in stages[4].select("doc_id", "text").collect()]
    assert all(c == i for i, (n, c) in brute(rows, P.SHINGLE).items() if n)
    before = [tuple(r) for r in stages[3].select("doc_id", "text").collect()]
    want = {i for i, (n, c) in brute(before, P.SHINGLE).items() if c == i}
    assert {i for i, _ in rows} == want


def test_packing_covers_what_is_left(stages):
    rows = stages[5].collect()
    assert {r["doc_id"] for r in rows} == {r[0] for r in stages[4].select("doc_id").collect()}
    check_layout([(r["sequence_id"], r["offset"], r["length"]) for r in rows])


def test_run_is_the_stages(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    a, b = (sorted(map(tuple, x.select(*key).collect())) for x in (P.run(spark, SF), stages[5]))
    assert a == b


@pytest.mark.parametrize("make", [awkward, empty])
def test_each_stage_on_awkward_rows(spark, make):
    for name, stage in P.STAGES:
        got = stage(spark, make(spark), SF)
        rows = got.collect()
        if name != "best_fit_packing":
            assert got.columns == make(spark).columns
        if make is empty:
            assert rows == []
    rng = random.Random(1)
    one = spark.createDataFrame([(1, sentence(rng, 50), "a")], "doc_id long, text string, source string")
    assert all(stage(spark, one, SF).count() == 1 for _, stage in P.STAGES[:1] + P.STAGES[2:])


def test_one_member_of_a_large_near_copy_group_survives(spark):
    """A third of a host's rows are near copies of one clean document."""
    rng = random.Random(21)
    clean = [sentence(rng, 9) for _ in range(20)]
    notice = sentence(rng, 12)
    rows = [(i, "\n".join([*(sentence(rng, 9) for _ in range(5)), *[notice] * (i < 60)]), "h")
            for i in range(200)]
    for i in range(1000, 1100):
        lines = [x.split() for x in clean]
        if i > 1000:
            lines[rng.randrange(20)][rng.randrange(9)] = f"changed{i}"
        rows.append((i, "\n".join(map(" ".join, lines)), "h"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    stages = dict(P.STAGES)
    ruled = stages["quality_rules"](spark, docs, SF)
    left = {r["doc_id"]: r["text"] for r in ruled.collect()}
    assert left == {i: t.replace("\n" + notice, "") for i, t, _ in rows}
    kept = stages["minhash_near_dedup"](spark, ruled, SF).collect()
    assert [r["text"] for r in kept if r["doc_id"] >= 1000] == ["\n".join(clean)]
