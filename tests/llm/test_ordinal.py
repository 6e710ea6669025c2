"""Held-out accuracy, order of thresholds, and defined results."""

import numpy as np
import pytest
from helpers import SF, awkward, documents, empty

from ledgerlens.llm import ordinal
from ledgerlens.llm.catalog import LLM_QUERIES, graded
from ledgerlens.sources.tables import read_table


@pytest.fixture(scope="module")
def rated():
    import duckdb
    d = "/root/testdata/sf0.1"
    rows = duckdb.sql(f"""SELECT text, CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 ELSE 2 END
        FROM '{d}/documents.parquet' JOIN '{d}/labels.parquet' USING (doc_id)
        ORDER BY hash(doc_id)""").fetchall()
    f = ordinal.Features()
    return [f.of(t) for t, _ in rows], np.array([g for _, g in rows])


def test_held_out_accuracy(rated):
    x, y = rated
    half = 3 * len(x) // 4
    model = ordinal.fit(x[:half], y[:half])
    assert (np.diff(model.thresholds) > 0).all()
    tail = np.array([model.at_least(model.weights[a].sum())[1] for a in x[half:]])
    kept, y = tail >= 0.5, y[half:]
    assert kept[y == 2].mean() > 0.98
    assert kept[y == 1].mean() < 0.25 and kept[y == 0].mean() < 0.2
    # expected grades rise with the true ones
    grade = np.array([model.at_least(model.weights[a].sum()).sum() for a in x[half:]])
    means = [grade[y == g].mean() for g in range(3)]
    assert means[0] < means[1] < means[2]


def test_probabilities_follow_the_link():
    m = ordinal.Model(np.zeros(4), np.array([-1.0, 0.5, 2.0]))
    p = m.at_least(0.3)
    assert np.allclose(p, 1 / (1 + np.exp(m.thresholds - 0.3)))
    assert (np.diff(p) < 0).all()


def test_gradient_raises_the_likelihood():
    rng = np.random.default_rng(0)
    rows, y = [], rng.integers(0, 3, 600)
    for g in y:
        rows.append(np.unique(np.concatenate([[g + 10], rng.integers(100, 200, 5)])).astype(np.int32))
    m = ordinal.fit(rows, y, bits=10)
    got = [int((m.at_least(m.weights[r].sum()) >= 0.5).sum()) for r in rows]
    assert np.mean(np.array(got) == y) > 0.95


def test_sample_bound_and_repeatability(spark):
    docs = read_table(spark, SF, "documents", ["doc_id", "text"])
    ratings = graded(read_table(spark, SF, "labels", ["doc_id", "quality", "toxic"]))
    a, b = (ordinal.train(docs, ratings, sample_rows=60) for _ in range(2))
    assert (a.weights == b.weights).all() and (a.thresholds == b.thresholds).all()


def test_query(spark):
    rows = LLM_QUERIES["op7_ordinal"](spark, SF).collect()
    assert {r["doc_id"] for r in rows} == {i for i, *_ in documents()}
    assert all(r["kept"] == (r["tail_prob"] >= 0.5) and 0 <= r["expected_grade"] <= 2 for r in rows)


def test_awkward_and_empty(spark):
    ratings = spark.createDataFrame([(1, 2), (6, 0), (None, 1), (7, None), (8, 1), (1, 1)],
                                    "doc_id long, grade int")
    model = ordinal.train(awkward(spark), ratings)
    rows = ordinal.score(awkward(spark), model).collect()
    assert len(rows) == 11 and all(r["score"] is not None for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert len({r["score"] for r in rows if r["doc_id"] in (3, 4)}) == 1
    none = ordinal.train(awkward(spark), ratings.filter("false"))
    assert none is None
    rows = ordinal.score(awkward(spark), none).collect()
    assert len(rows) == 11 and all(r["kept"] and r["score"] is None for r in rows)
    assert ordinal.score(empty(spark), model).count() == 0
