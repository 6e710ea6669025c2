"""Property tests: the Column expressions of the cleaning rules agree with a
plain-Python statement of each rule on random inputs."""

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.functions.clean import (
    is_blank, jvm_trim, norm_state, promo_count_profile, promo_count_raw, valid_state)

ALPHABET = st.sampled_from(list("ab,, \t") + ["X", "null", "NULL"])
TEXT = st.one_of(st.none(), st.lists(ALPHABET, max_size=8).map("".join))


def _raw(p):
    if p is None or p.strip(" ") == "":
        return 0
    return len(p.strip(" ").split(","))


def _profile(p):
    if p is None or p.strip(" ") == "":
        return 0
    return len([t for t in p.strip(" ").split(",") if t.strip(" ")])


def _jvm_trim(s):
    return None if s is None else s.strip("".join(chr(c) for c in range(0x21)))


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_promo_counts(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = df.select(promo_count_raw("p").alias("r"), promo_count_profile("p").alias("f")).collect()
    assert [r.r for r in got] == [_raw(t) for t in texts]
    assert [r.f for r in got] == [_profile(t) for t in texts]


@settings(max_examples=8, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_state_rules(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = df.select(jvm_trim("s").alias("t"), norm_state("s").alias("n"),
                    valid_state("s").alias("v"), is_blank("s").alias("b")).collect()
    for t, r in zip(texts, got):
        trimmed = _jvm_trim(t)
        assert r.t == trimmed
        assert r.n == (None if trimmed is None else trimmed.upper())
        assert bool(r.v) == (trimmed is not None and trimmed != "" and trimmed.upper() != "NULL")
        assert r.b == (t is None or trimmed == "")
