"""Sizes, slots, cut edges, and the defined results."""

import random
import zlib
from collections import Counter, defaultdict

from helpers import SF, awkward, documents, empty

from ledgerlens.llm import label_shards
from ledgerlens.llm.catalog import LLM_QUERIES


def check(rows, shards=16):
    by = defaultdict(list)
    for r in rows:
        assert 0 <= r["shard"] < shards
        by[r["shard"]].append(r["slot"])
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))


def test_query(spark):
    texts = {i: (t or "").encode() for i, t, _ in documents("/root/testdata/sf0.01")}
    rows = LLM_QUERIES["op10_label_shards"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    check(rows)
    load, where = Counter(), defaultdict(set)
    for r in rows:
        t = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (len(t) + 1, zlib.crc32(t))
        assert (r["law"], r["grown_shard"]) == ("bytes", None)
        load[r["shard"]] += r["size"]
        where[t].add(r["shard"])
    mean = sum(load.values()) / 16
    assert max(load.values()) < 1.02 * mean and min(load.values()) > 0.98 * mean
    assert all(len(s) == 1 for s in where.values())         # no edge is cut


def test_a_group_larger_than_a_shard(spark):
    """A third of all rows are one text: it fills some shards and is cut no further."""
    rows = [(i, "one text of many copies " * 4) for i in range(1000)]
    rows += [(1000 + i, f"text number {i} " + "x" * (i % 90)) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = label_shards.assign(df).collect()
    check(got)
    load, hot = Counter(), Counter()
    for r in got:
        load[r["shard"]] += r["size"]
        hot[r["shard"]] += r["doc_id"] < 1000
    mean = sum(load.values()) / 16
    assert max(load.values()) < 1.05 * mean and min(load.values()) > 0.95 * mean
    assert sum(n > 0 for n in hot.values()) < 16
    assert sum(n * n for n in hot.values()) > 2 * 1000 * 1000 / 16


def test_propagation_ends_where_nothing_can_move(spark):
    """Many groups that compete for few shards: against the rule for a move, unit by unit."""
    rng = random.Random(17)
    units = []
    for g in range(60):
        size = rng.randint(1, 40)
        for start, place in {(rng.randrange(4), rng.randrange(64)) for _ in range(rng.randint(2, 30))}:
            n = rng.randint(1, 6)
            units.append((g, g, size, start, place, n, n * size))
    df = spark.createDataFrame(
        units, "hash long, crc long, size long, start int, place int, n long, bytes long")
    quota = sum(u[-1] for u in units) // 2                 # the other half is not linked
    got = label_shards._propagate(df, quota, 4, 8).collect()
    assert Counter((r["hash"], r["start"], r["place"], r["n"]) for r in got) == Counter(
        (u[0], u[3], u[4], u[5]) for u in units)
    load, weight = Counter(), Counter()
    for r in got:
        load[r["shard"]] += r["bytes"]
        weight[r["hash"], r["shard"]] += r["n"]
    first = Counter()
    for u in units:
        first[u[3]] += u[-1]
    assert all(load[s] <= max(quota, first[s]) for s in range(4))
    free = {s: quota - load[s] if quota - load[s] > quota // label_shards.FULL else 0
            for s in range(4)}
    for r in got:
        g, here = r["hash"], r["shard"]
        open_ = [s for s in range(4) if free[s] >= r["size"] and weight[g, s]]
        if open_:
            best = max(open_, key=lambda s: (weight[g, s], -s))
            better = best != here and (weight[g, best], -best) > (weight[g, here], -here)
            assert not better or r["bytes"] > free[best]
    # far fewer shards for a group than at the start
    spread = [sum(weight[g, s] > 0 for s in range(4)) for g in range(60)]
    begun = [len({u[3] for u in units if u[0] == g}) for g in range(60)]
    assert sum(spread) < 0.6 * sum(begun)


def test_repeatable(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    a, b = (sorted(map(tuple, label_shards.assign(df).collect())) for _ in range(2))
    assert a == b


def test_awkward_and_empty(spark):
    rows = label_shards.assign(awkward(spark)).collect()
    assert len(rows) == 11
    check(rows)
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4)} == {1}
    assert label_shards.assign(empty(spark)).count() == 0
