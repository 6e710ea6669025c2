"""Encoding and decoding equal the tokenizers library on any text."""

import hashlib
import random
import struct

import pytest
from helpers import SF, awkward, documents, empty
from tokenizers import Tokenizer

from ledgerlens.llm import bpe
from ledgerlens.llm.catalog import ENCODE_WITH, LLM_QUERIES, PACK_WITH

PIECES = ["a", "b", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "'s", "'LL",
          "É", "é", "Σ", "ΑΣ", "İ", "ß", "1", "²", "½", "!", "?", "</w>", "<|endoftext|>",
          "<|startoftext|>", "\U0001f600", "中", "​", "\x00", "ing", "tion", "\xad", "ǅ", "ﬁ"]


@pytest.mark.parametrize("path", [ENCODE_WITH, PACK_WITH])
def test_random_texts(path):
    ours, theirs = bpe.Vocabulary(bpe.read_spec(path)), Tokenizer.from_file(path)
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["", "x" * 3000, "ab" * 2000, "étion" * 500, "!?" * 700]
    for text, ids in zip(texts, ours.encode_group(texts)):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, text
        assert ours.decode(ids) == theirs.decode(want, skip_special_tokens=False), text


@pytest.mark.parametrize("path", [ENCODE_WITH, PACK_WITH])
def test_words_between_single_spaces(path):
    """The usual texts, which are cut without a pattern; and one odd space among them."""
    ours, theirs = bpe.Vocabulary(bpe.read_spec(path)), Tokenizer.from_file(path)
    rng = random.Random(7)
    words = ["the", "house,", "1984", "'s", "É", "étion.", "x-y", "中文", "Σας", "\U0001f600!"]
    texts = []
    for _ in range(1500):
        parts = [rng.choice(words) + rng.choice(" \n") for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            parts.insert(rng.randint(0, len(parts)), rng.choice(
                [" ", "\n", "  ", "\t", "\r\n", "\x1c", "\x85", "\xa0", "\u2003 ", "\u3000", "\0", "—"]))
        texts.append("".join(parts))
    for text, ids in zip(texts, ours.encode_group(texts)):
        want = theirs.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, text


@pytest.mark.parametrize("path", [ENCODE_WITH, PACK_WITH])
def test_every_character(path):
    ours, theirs = bpe.Vocabulary(bpe.read_spec(path)), Tokenizer.from_file(path)
    every = [c for c in range(0x80, 0x40000) if not 0xD800 <= c <= 0xDFFF]
    for lo in range(0, len(every), 20_000):
        texts = [f"a{chr(c)}b 1{chr(c)}! {chr(c)}" for c in every[lo:lo + 20_000]]
        got = ours.encode_group(texts)
        ours.forget()
        for text, a, b in zip(texts, got, theirs.encode_batch(texts, add_special_tokens=False)):
            assert list(struct.unpack(f"<{len(a) // 4}I", a)) == b.ids, text


def test_a_worker_keeps_no_words():
    v = bpe.Vocabulary(bpe.read_spec(PACK_WITH))
    first = v.encode("some words here")
    v.forget()
    assert not v.memo and not v.old and v.encode("some words here") == first


def test_no_merge_crosses_a_forced_boundary():
    v = bpe.Vocabulary(bpe.read_spec(PACK_WITH))
    a, b = next((a, b) for a in range(97, 123) for b in range(97, 123)
                if not v.inside[a << 8 | b])
    left, right = "hou" + chr(a), chr(b) + "ing"
    assert v.encode(left + right) == v.encode(left) + v.encode(right)


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 50)
    v = bpe.Vocabulary(bpe.read_spec(PACK_WITH))
    texts = [f"word{i} other{i}" for i in range(200)]
    first = [v.encode(t) for t in texts]
    assert len(v.memo) <= 60 and len(v.old) <= 60
    assert [v.encode(t) for t in texts] == first


def test_query_over_whole_table(spark):
    theirs = Tokenizer.from_file(ENCODE_WITH)
    want = {}
    for doc_id, text, _ in documents():
        ids = theirs.encode(text or "", add_special_tokens=False).ids
        decoded = theirs.decode(ids, skip_special_tokens=False)
        want[doc_id] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest())
    got = {r[0]: tuple(r[1:]) for r in LLM_QUERIES["op1_bpe"](spark, SF).collect()}
    assert got == want


def test_awkward_and_empty(spark):
    spec = bpe.read_spec(ENCODE_WITH)
    ids = bpe.encode(awkward(spark), spec)
    rows = bpe.decode(ids, spec, keep=("doc_id", "n_tokens")).collect()
    assert len(rows) == 11
    assert {(r["n_tokens"], r["decoded"]) for r in rows if r["doc_id"] in (3, 4, 5)} == {(0, "")}
    assert bpe.encode(empty(spark), spec).count() == 0
