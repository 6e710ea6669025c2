"""Recall against brute force, and the defined results."""

import duckdb
import numpy as np
import pytest
from helpers import SF

from ledgerlens.llm import ann
from ledgerlens.llm.catalog import LLM_QUERIES


def exact(ids, x, queries, k=10):
    out = {}
    for q in queries:
        i = ids.index(q)
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = sorted((float(d[j]), ids[j]) for j in range(len(ids)) if ids[j] != q)[:k]
        out[q] = order
    return out


def recall(rows, want):
    got = {}
    for r in rows:
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == set(want)
    hits = total = 0
    for q, rs in got.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, len(want[q]) + 1))
        assert [(r["score"], r["vec_id"]) for r in rs] == sorted((r["score"], r["vec_id"]) for r in rs)
        true = dict((v, d) for d, v in want[q])
        hits += sum(r["vec_id"] in true for r in rs)
        total += len(true)
        for r in rs:
            assert r["vec_id"] not in true or abs(true[r["vec_id"]] - r["score"]) < 1e-9
    return hits / total


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.1"])
def test_query_recall(spark, sf):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{sf}/embeddings.parquet'").fetchall()
    ids, x = [r[0] for r in rows], np.array([r[1] for r in rows], np.float64)
    want = exact(ids, x, [i for i in ids if i % 100 == 0])
    assert recall(LLM_QUERIES["op2_ann"](spark, sf).collect(), want) >= 0.95


def test_split_cells_and_descent(spark, monkeypatch):
    """Small cells, so that partitions, splitting and descent all take part."""
    monkeypatch.setattr(ann, "LEAF", 32)
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.standard_normal((300, 8)),
                        1 + 1e-3 * rng.standard_normal((200, 8))]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.nearest(df, lambda v: v % 10 == 0).collect()
    want = exact(list(range(500)), x.astype(np.float64), range(0, 500, 10))
    assert recall(got, want) >= 0.9


def test_descent_goes_on_until_little_changes(spark, monkeypatch):
    """Random directions in small cells: rounds follow from what changes."""
    monkeypatch.setattr(ann, "LEAF", 64)
    monkeypatch.setattr(ann, "TREES", 3)
    shares, descend = [], ann.descend

    def counted(graph, vectors):
        out = descend(graph, vectors)
        shares.append(out.filter("new").count() / out.count())
        return out
    monkeypatch.setattr(ann, "descend", counted)
    x = np.random.default_rng(9).standard_normal((3000, 12)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                               "vec_id long, embedding array<float>")
    got = ann.nearest(df, lambda v: v % 50 == 0).collect()
    assert recall(got, exact(list(range(3000)), x.astype(np.float64), range(0, 3000, 50))) >= 0.95
    assert len(shares) >= 3 and shares[-1] <= ann.CHANGED < shares[-2]


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "a"), (100, [1.0, 0.0], "a"), (5, [1.0, 0.0], "b"),
            (5, [1.0, 0.0], "b"), (200, [0.0, 2.0], "c"), (1, None, None), (2, [0.0, 0.0], "z"),
            (3, [nan, 1.0], "z"), (4, [inf, 1.0], "z"), (6, [None, 1.0], "z"), (7, [], "z"),
            (8, [1.0, 2.0, 3.0], "z"), (None, [1.0, 1.0], "z"), (300, [0.0, 0.0], "z")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 6))
                 for r in ann.nearest(df, lambda v: v % 100 == 0).collect())
    far = round(5 ** 0.5, 6)
    assert got == [(0, 1, 5, 0.0), (0, 2, 100, 0.0), (0, 3, 200, far),
                   (100, 1, 0, 0.0), (100, 2, 5, 0.0), (100, 3, 200, far),
                   (200, 1, 0, far), (200, 2, 5, far), (200, 3, 100, far)]


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(400)] + [(400, [1.0, 2.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r["vec_id"] for r in sorted(ann.nearest(df, lambda v: v == 400).collect(),
                                       key=lambda r: r["rank"])]
    assert got == list(range(10))


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(df, lambda v: v % 100 == 0).count() == 0
