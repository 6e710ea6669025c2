"""Pieces equal the tokenizers library's ids; sequences are gapless and nearly full."""

import struct
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import SF, awkward, documents, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlens.llm import packing
from ledgerlens.llm.catalog import LLM_QUERIES, PACK_WITH, pack_documents


def check_layout(rows, capacity=2048):
    """rows: (sequence, offset, length); no gap, no overlap, none too long."""
    by = defaultdict(list)
    for s, o, n in rows:
        by[s].append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_cut():
    assert packing.cut(1) == [(0, 1)]
    assert packing.cut(2048) == [(0, 2048)]
    assert packing.cut(2049) == [(0, 1), (1, 2048)]
    assert packing.cut(4096) == [(0, 2048), (2048, 2048)]
    assert packing.cut(5000) == [(0, 904), (904, 2048), (2952, 2048)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=300))
def test_sequences_are_valid(lengths):
    s, o = packing.sum_of_squares(lengths, 64)
    used = check_layout(list(zip(s.tolist(), o.tolist(), lengths)), 64)
    assert used == (max(s) + 1 if len(s) else 0)
    assert used <= 2 * -(-sum(lengths) // 64) + 1


def test_placement_takes_the_smallest_sum_of_squares():
    """Against a plain loop over all gaps."""
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 40, 300))[::-1]
    got, _ = packing.sum_of_squares(lengths, 40)
    gaps, counts = [], defaultdict(int)
    for s, bin_ in zip(lengths.tolist(), got.tolist()):
        def after(g, s=s):
            c = dict(counts)
            if g < 40:
                c[g] -= 1
            if g > s:
                c[g - s] = c.get(g - s, 0) + 1
            return sum(v * v for v in c.values())
        best = min(after(g) for g in {40, *(g for g, n in counts.items() if n and g >= s)})
        g = gaps[bin_] if bin_ < len(gaps) else 40
        assert after(g) == best
        if g == 40:
            gaps.append(40 - s)
        else:
            counts[g] -= 1
            gaps[bin_] = g - s
        if g > s:
            counts[g - s] += 1


def test_query_over_whole_table(spark):
    theirs, want = Tokenizer.from_file(PACK_WITH), {}
    for doc_id, text, _ in documents():
        ids = [*theirs.encode(text or "", add_special_tokens=False).ids, 0]
        for k, (start, n) in enumerate(packing.cut(len(ids))):
            raw = struct.pack(f"<{n}I", *ids[start:start + n])
            want[doc_id, k] = (start, n, zlib.crc32(raw))
    rows = LLM_QUERIES["op3_pack"](spark, SF).collect()
    assert {(r[0], r[1]): tuple(r[2:5]) for r in rows} == want
    used = check_layout([(r["sequence_id"], r["offset"], r["length"]) for r in rows])
    assert used <= 1.03 * sum(r["length"] for r in rows) / 2048 + 1


def test_groups_split_the_work(spark):
    parts = spark.range(500).selectExpr("id AS doc_id", "0 AS piece", "id % 97 + 1 AS length")
    rows = packing.pack(parts, 128, group_rows=100).collect()
    assert len(rows) == 500 and len({r["sequence_id"] >> 32 for r in rows}) > 1
    check_layout([(r["sequence_id"], r["offset"], r["length"]) for r in rows], 128)


@pytest.mark.parametrize("make, count", [(awkward, None), (empty, 0)])
def test_awkward_and_empty(spark, make, count):
    rows = pack_documents(spark, make(spark)).collect()
    check_layout([(r["sequence_id"], r["offset"], r["length"]) for r in rows])
    if count is None:
        assert sorted(r["length"] for r in rows if r["doc_id"] in (3, 4)) == [1, 1]
        assert sum(r["piece"] == 0 for r in rows) == 11
    else:
        assert len(rows) == count
