"""Deleted runs against brute force; the winnowing guarantee; defined results."""

import random
from unittest.mock import patch

import numpy as np
from helpers import SF, awkward, documents, empty, sentence
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import winnow
from ledgerlens.llm.catalog import LLM_QUERIES


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.!? \n\x00", max_size=80))
def test_units_join_to_the_text(text):
    assert "".join(winnow.units(text)) == text


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 5), min_size=3, max_size=6), st.lists(st.integers(0, 5), max_size=8),
       st.lists(st.integers(0, 5), max_size=8))
def test_equal_runs_share_a_fingerprint(run, before, after):
    """Any GRAM + WINDOW - 1 equal units in two places are selected at the same place."""
    size = winnow.GRAM + winnow.WINDOW - 1
    for lo in range(len(run) - size + 1):
        a = np.array([*before, *run], np.int64) * 7919
        b = np.array([*run, *after], np.int64) * 7919
        (pa, fa), (pb, fb) = winnow.select(a), winnow.select(b)
        at_a = {(p - len(before), f) for p, f in zip(pa.tolist(), fa.tolist())}
        at_b = set(zip(pb.tolist(), fb.tolist()))
        assert any(lo <= p <= lo + size - winnow.GRAM for p, _ in at_a & at_b)


def brute(rows):
    """{doc: covered units}: units of grams of MIN_UNITS that stand earlier."""
    seen, covered = {}, {}
    for doc, text in sorted(rows):
        parts = [" ".join(u.lower().split()) for u in winnow.units(text)]
        parts = [u for u in parts if u]
        marks = [False] * len(parts)
        for i in range(len(parts) - winnow.MIN_UNITS + 1):
            gram = tuple(parts[i:i + winnow.MIN_UNITS])
            if gram in seen:
                for k in range(winnow.MIN_UNITS):
                    marks[i + k] = True
            else:
                seen[gram] = (doc, i)
        covered[doc] = marks
    return covered


def test_long_runs_are_found_like_by_brute_force(spark):
    rng = random.Random(8)
    passages = [" ".join(sentence(rng, 9).capitalize() + "." for _ in range(7)) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = [" ".join(sentence(rng, 8) + "." for _ in range(3)) for _ in range(4)]
        parts.insert(rng.randint(0, 4), rng.choice(passages))
        rows.append((i, rng.choice([" ", "\n"]).join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    for r in winnow.dedup(df).collect():
        doc, text = r["row"]["doc_id"], r["row"]["text"]
        assert r["removed"]["n_units"] == sum(want[doc])
        if not sum(want[doc]):
            assert text == dict(rows)[doc]
    # each passage stays in the first document that has it, and only there
    left = [r["row"]["text"] for r in winnow.dedup(df).collect()]
    for p in passages:
        assert sum(p in t for t in left) == min(1, sum(p in t for _, t in rows))


def test_runs_inside_one_document(spark):
    rng = random.Random(5)
    run = " ".join(sentence(rng, 9) + "." for _ in range(5))
    text = f"{run}\nbetween the two copies.\n{run}\nend of it."
    row = winnow.dedup(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["row"]["text"].count(run) == 1 and row["removed"]["n_runs"] == 1


def test_short_runs_stay(spark):
    rows = [(i, f"All rights reserved. See the page {i} of this. Thanks.") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r["row"]) for r in winnow.dedup(df).collect()} == set(rows)


def test_copies_can_be_spared(spark):
    rng = random.Random(6)
    text = " ".join(sentence(rng, 9) + "." for _ in range(9))
    df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
    assert sorted(r["row"]["text"] == text for r in winnow.dedup(df).collect()) == [False, True]
    assert all(r["row"]["text"] == text for r in winnow.dedup(df, spare_percent=80).collect())


def test_a_very_long_text_leaves_nothing_behind():
    """20 million characters: hashed by blocks; the worker keeps no powers of that length."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    some = " ".join(f"w{n}" for n in rng.integers(0, 500_000, 600_000)) + "\n"
    text = some * 5 + "x" * 3_000_000
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([77]), pa.array([text])],
                                       names=["doc", "whole", "value"])
    out = winnow._places(batch)
    assert len(text) > 20_000_000 and out.num_rows > 100_000
    seen = set(out.column("fp").to_pylist())
    assert len(seen) < 0.3 * out.num_rows               # the five parts have the same grams
    winnow._forget()
    assert sum(len(p) for p in winnow._powers) == 2


def test_word_hashes_do_not_depend_on_blocks(monkeypatch):
    texts = [sentence(random.Random(1), 300), "a " * 50 + "y" * 5000 + " b", ""]
    whole = [h.tolist() for h, _ in winnow._words(texts)]
    for size in (1, 7, 100):
        monkeypatch.setattr(winnow, "BLOCK_CHARS", size)
        assert [h.tolist() for h, _ in winnow._words(texts)] == whole


def test_query_over_whole_table(spark):
    rows = LLM_QUERIES["op9_winnow"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == {i for i, *_ in documents()}


def test_awkward_and_empty(spark):
    df = awkward(spark)
    rows = winnow.dedup(df).collect()
    assert sorted(str(tuple(r["row"])) for r in rows) == sorted(str(tuple(r)) for r in df.collect())
    assert all(r["removed"]["n_runs"] == 0 for r in rows)
    assert winnow.dedup(empty(spark)).count() == 0


def reference(rows):
    """{doc: covered words}: whole-unit runs of MIN_WORDS words that stand earlier, with
    every run compared in full."""
    seen, out = set(), {}
    for doc, text in sorted(rows):
        parts = [u.lower().split() for u in winnow.units(text)]
        at = np.cumsum([0, *map(len, parts)])
        marks, here = [False] * int(at[-1]), []
        for i in range(len(parts)):
            for j in range(i + 1, len(parts) + 1):
                if at[j] - at[i] >= winnow.MIN_WORDS:
                    run = tuple(w for p in parts[i:j] for w in p)
                    if run in seen:
                        marks[at[i]:at[j]] = [True] * int(at[j] - at[i])
                    here.append(run)
        seen.update(here)
        out[doc] = sum(marks)
    return out


def test_runs_of_whole_units_need_no_number_of_units(spark):
    """Passages of 1 to 4 sentences, whatever else the first holder has beside them."""
    rng = random.Random(11)
    said = [sentence(rng, n).capitalize() + "." for n in (24, 30, 12, 9, 14, 11, 21, 8)]
    rows = []
    for i in range(40):
        lo = rng.randint(0, 6)
        some = said[lo:lo + rng.randint(1, 4)]
        rows.append((i, "\n".join([sentence(rng, 19) + ".", *some, sentence(rng, 17) + "."])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["removed"]["n_words"] for r in winnow.dedup(df).collect()}
    assert got == reference(rows)


def test_passages_cut_in_mid_sentence(spark):
    """Passages of 60 words in 1 to 4 sentences, pasted between words of other sentences."""
    rng = random.Random(12)
    rows = []
    for k in range(1, 5):
        body = sentence(rng, 60).split()
        for cut in range(60 // k, 60, 60 // k):
            body[cut - 1] += "."
        for i in range(3):
            rows.append((10 * k + i, f"{sentence(rng, 15)} {' '.join(body)} {sentence(rng, 15)}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in winnow.dedup(df).collect():
        removed = r["removed"]["n_words"]
        assert removed == 0 if r["row"]["doc_id"] % 10 == 0 else 20 <= removed <= 62


def test_long_equal_runs_share_a_word_gram():
    rng = np.random.default_rng(3)
    size = winnow.GRAM + winnow.WINDOW - 1
    for _ in range(200):
        run = rng.integers(0, 1 << 62, size)
        a, b = (np.concatenate([rng.integers(0, 1 << 62, n), run]) for n in (7, 90))
        (pa, fa), (pb, fb) = winnow.select(a), winnow.select(b)
        shared = {(p - 7, f) for p, f in zip(pa.tolist(), fa.tolist())} & {
            (p - 90, f) for p, f in zip(pb.tolist(), fb.tolist())}
        assert any(p >= 0 for p, _ in shared)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abÉ.!? \n\t\x1c　\U0001f600", max_size=60))
def test_words_and_unit_ends_are_read_like_by_split(text):
    _, starts, stops, ends = winnow._read(text)
    assert [text[a:b] for a, b in zip(starts, stops)] == text.split()
    sizes = [len(u.split()) for u in winnow.units(text) if u.split()]
    assert winnow._ends(ends).tolist() == [0, *np.cumsum(sizes, dtype=int).tolist()]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aÉ. \n\x1f\x85\u2003\u3000\U0001f600", max_size=12), max_size=6),
       st.integers(1, 30))
def test_texts_read_side_by_side_are_read_like_alone(texts, chars):
    with patch.object(winnow, "BATCH_CHARS", chars):
        each = [[x.tolist() for x in read] for read in winnow._read_each(texts)]
    assert each == [[x.tolist() for x in winnow._read(t)[1:]] for t in texts]


def test_places_meet_repeated_fingerprints_without_a_sort(spark):
    """Sorting all fingerprints was the dearest step of the join; it is by hash, and the
    stored repeated places are what it gives."""
    prints = spark.range(20000).selectExpr("id % 15000 AS fp", "id AS doc", "id AS place", "0 AS length")
    plans = []

    def stored(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)
    real = winnow.stored
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with patch.object(winnow, "stored", stored):
            assert winnow.matches(prints).count() == 5000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = dict(plans)["repeated-places"]
    assert "ShuffledHashJoin" in plan and "Sort" not in plan


def test_first_holder_with_other_neighbours_does_not_hide_a_run(spark):
    """A, B, C repeat between two later documents; the first holder of B, C has X before."""
    rng = random.Random(13)
    a, b, c, d, x, y, z = (sentence(rng, 8) + "." for _ in range(7))
    rows = [(1, f"{x} {b} {c} {y}"), (2, f"{y} {a} {b} {c} {z}"), (3, f"{z} {a} {b} {c} {x}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["row"]["doc_id"]: r["row"]["text"] for r in winnow.dedup(df).collect()}
    assert left == {1: rows[0][1], 2: rows[1][1], 3: f"{z} {x}"}
    # two short matches side by side, from different documents, are no run
    rows = [(1, f"{a} {b} {x}"), (2, f"{c} {d} {y}"), (3, f"{z} {a} {b} {c} {d}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r["row"]) for r in winnow.dedup(df).collect()} == set(rows)


def test_only_near_copies_of_one_document_are_spared(spark):
    """An excerpt, a mixture and a text below the limit are cut; a near copy is not."""
    rng = random.Random(14)
    said = [[sentence(rng, 10) + "." for _ in range(20)] for _ in range(2)]
    a, b = (" ".join(x) for x in said)
    end = sentence(rng, 8) + "."
    rows = [(1, a), (2, b),
            (3, " ".join(said[0][4:10])),                       # excerpt
            (4, " ".join(said[0][:10] + said[1][:10])),         # of two documents
            (5, " ".join([*said[0][:17], sentence(rng, 30)])),  # 85 % of it, Jaccard below 0.8
            (6, f"{a} {end}")]                                  # near copy
    df = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["row"]["doc_id"]: r["row"]["text"]
            for r in winnow.dedup(df, spare_percent=80).collect()}
    whole = dict(rows)
    assert [i for i in whole if left[i] == whole[i]] == [1, 2, 6]
    assert left[3] == left[4] == "" and len(left[5].split()) == 30


def test_matches_are_extended_to_the_last_equal_word(spark):
    """Passages of 50 words and more go whole, wherever they are cut, and between selected
    grams too; the words around them stay."""
    rng = random.Random(15)
    rows, left = [], {}
    for k in range(40):
        body = sentence(rng, rng.randint(50, 160))
        for i in range(3):
            a, b = (sentence(rng, rng.randint(1, 25)) for _ in range(2))
            rows.append((10 * k + i, f"{a} {body.upper() if i == 2 else body} {b}"))
            left[10 * k + i] = f"{a} {b}" if i else rows[-1][1]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["row"]["doc_id"]: r["row"]["text"] for r in winnow.dedup(df).collect()}
    assert got == left


def test_extension_meets_other_first_holders_and_document_ends(spark):
    """Each part of a run has a first holder of its own; whole texts; repeated rows."""
    rng = random.Random(16)
    a, b, c = (sentence(rng, 60) for _ in range(3))
    ends = [sentence(rng, 9) for _ in range(6)]
    rows = [(1, f"{ends[0]} {a} {ends[1]}"), (1, f"{ends[0]} {a} {ends[1]}"),
            (2, f"{ends[2]} {b} {ends[3]}"), (3, f"{ends[4]} {a} {b} {ends[5]}"),
            (4, c), (5, f"{c} {ends[0]}"), (6, f"{ends[1]} {c}"), (7, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [*rows[:3], (3, f"{ends[4]} {ends[5]}"), (4, c), (5, ends[0]), (6, f"{ends[1]} "), (7, "")]
    assert sorted(tuple(r["row"]) for r in winnow.dedup(df).collect()) == sorted(want)


def test_extension_inside_one_document(spark):
    """The words that follow a repeated unit go as far as they repeat."""
    rng = random.Random(17)
    run, tail = sentence(rng, 25) + ".", sentence(rng, 45).split()
    text = f"{run} {' '.join(tail)}\nAnd then. {run} {' '.join(tail[:35])} other end"
    row = winnow.dedup(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["row"]["text"] == f"{run} {' '.join(tail)}\nAnd then. other end"
    assert row["removed"]["n_words"] == 60
