"""Base counts against plain Python; frequent lines, copies and depleted documents."""

import random
import re

from helpers import SF, awkward, documents, empty, sentence

from ledgerlens.llm import line_frequency
from ledgerlens.llm.catalog import LLM_QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered), n < 20 or 100 * len(covered) > 30 * n)


def counts(row):
    return tuple(row[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                  "n_repeat_words", "base_failed"))


def test_query_base_counts(spark):
    want = {i: plain(t) for i, t, _ in documents()}
    rows = LLM_QUERIES["op8_line_frequency"](spark, SF).collect()
    assert {r["doc_id"]: counts(r) for r in rows} == want


def test_repeats(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice("ab") for _ in range(n)) for n in range(0, 40)]
    texts += ["a\nb\na\n\n \n b\nb", "x " * 30, "\x0b\x0c\r", "#*$%&|<> é#", " a  b ", "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: counts(r) for r in line_frequency.base_counts(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}


def corpus(spark):
    """150 texts of one host, 40 with a frequent line; 2 of them little else; 60 copies."""
    rng = random.Random(4)
    notice = "Sign up here for our  weekly letter of NEWS  " + " ".join(f"offer{i}" for i in range(20))
    rows = [(i, sentence(rng, 40) + ("\n" + notice if i < 38 else ""), "h") for i in range(148)]
    rows += [(148 + i, notice + "\nplus " + sentence(rng, 3), "h") for i in range(2)]
    rows += [(200 + i, "the same text in many copies " * 1 + sentence(random.Random(9), 30), "h")
             for i in range(60)]
    rows += [(300 + i, sentence(rng, 30) + "\n" + notice, "other") for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), notice


def test_frequent_lines_and_depleted_documents(spark):
    df, notice = corpus(spark)
    rows = {r["doc_id"]: r for r in line_frequency.judge(df).collect()}
    n = len(notice.split())
    assert all(rows[i]["n_removed_words"] == n for i in range(38))
    assert all(rows[i]["kept"] for i in rows if i not in (148, 149))
    assert not rows[148]["kept"] and not rows[148]["base_failed"]
    # copies count once, and five texts of another host are too few
    assert all(rows[i]["n_removed_words"] == 0 for i in rows if i >= 200)


def test_clean_removes_lines_and_rows(spark):
    df, notice = corpus(spark)
    before = {r["doc_id"]: r["text"] for r in df.collect()}
    after = {r["doc_id"]: r["text"] for r in line_frequency.clean(df).collect()}
    assert set(before) - set(after) == {148, 149}
    for i, text in after.items():
        assert text == (before[i].replace("\n" + notice, "") if i < 148 else before[i])


def test_awkward_and_empty(spark):
    rows = line_frequency.judge(awkward(spark)).collect()
    assert len(rows) == 11
    assert {r["n_words"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    left = line_frequency.clean(awkward(spark))
    assert left.columns == awkward(spark).columns
    assert [r["doc_id"] for r in left.collect()] == []      # too short, or words repeat
    assert line_frequency.judge(empty(spark)).count() == 0
    assert line_frequency.clean(empty(spark)).count() == 0


def test_filters_on_the_verdict_stay_above_the_counting(spark):
    """A filter on the result neither repeats the counting in the plan nor takes long."""
    import time
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = line_frequency.judge(docs)
    rows = judged.collect()
    began = time.time()
    for condition in ("kept", "NOT base_failed", "n_words > 100 AND kept"):
        found = judged.filter(condition)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        whole = judged._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("xxhash64") <= whole.count("xxhash64")
        assert found.count() == len([r for r in rows if {
            "kept": r["kept"], "NOT base_failed": not r["base_failed"],
            "n_words > 100 AND kept": r["n_words"] > 100 and r["kept"]}[condition]])
    assert time.time() - began < 60
