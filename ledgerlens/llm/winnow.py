"""Deduplication of repeated passages by fingerprints of word runs.

A unit is a physical line, cut further after the end of each sentence.  Words are
compared in lower case; white space does not count.  Two kinds of runs are looked
up, both as hashes of their words:

* unit grams: for each unit, the shortest run of whole units of ``MIN_WORDS`` words
  or more that starts with it, and the one that ends with it.  Any repeated run of
  whole units with that many words is the union of such grams, so it is found to its
  last unit, be it one long sentence or ten short ones;
* word grams: ``GRAM`` = ``MIN_WORDS`` neighbouring words, wherever they begin; of
  each ``WINDOW`` neighbouring ones the smallest is selected.  Any repeated run of
  ``GRAM + WINDOW - 1`` = 50 words therefore shares a selected gram (the winnowing
  guarantee), also when it begins and ends in the middle of sentences.

Positions are joined gram by gram: each with the first one of its gram, in the order
of document id and place -- never all pairs.  Matches that run on beside the same holder
are one segment; each segment is extended both ways, word by word, as long as the words
are equal.  The union of a document's extended segments is deleted: all places but the
first.  Word grams count against other documents only: a loop inside a line is not a
pasted passage.

``EDGE`` = ``WINDOW - 1`` = 30 words beside a segment are all that extension in another
document can add: of a repeated run any 50 words hold a selected gram, so its first begins
30 words after the run at most and its last ends 30 words before the run's end at most,
and the first holder of such a gram comes before the document too.  Words beyond are
beside another segment.  Inside one document there is no such limit, and none is set.

Plan: one pass makes the grams, three longs each; which of them repeat is a count of their
hashes alone with map-side combine, so a passage in a third of all documents is one
row per task; the join back is on the gram, its small side holds the repeated grams
only, and it is one whose hot partitions Spark splits.  First positions are an
aggregation of the repeated grams.  Holders give the words beside each place that a
segment touches, once per place, and these move to the segments.  Texts are shuffled once
for both: to the places asked for, and to their segments.  Only holders and texts with
segments go through Python again.

Defined results: null or empty texts have no words and come back unchanged, as do
rows with a null id; rows equal in id and text are one document (all of its rows
come back the same); rows that share an id but not the text are different
documents; a text without deletions is returned as it is, byte for byte.  All
columns come back, whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.scratch import stored

MIN_UNITS = 1              # the word count alone decides
MIN_WORDS = 20
GRAM = MIN_WORDS
WINDOW = 31                # 50 words in a row hold a selected gram
EDGE = WINDOW - 1          # words beside a segment that no other one covers
LOW = (1 << 32) - 1
BATCH_CHARS = 1 << 17      # texts whose characters are read side by side: a core's cache holds them
BLOCK_CHARS = 1 << 20      # characters hashed side by side

BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64)] * 2
_SPACE = np.array([chr(c).isspace() for c in range(0x3001)] + [False])


def units(text: str) -> list[str]:
    """The text cut after line breaks and after . ! ? before a blank; joined again
    the units are the text."""
    # a character that the text does not have marks the cuts
    mark = next(c for c in map(chr, [0, *range(0xE000, 0xF900)]) if c not in text)
    for end in (". ", "! ", "? ", "\n"):
        text = text.replace(end, end + mark)
    return [u for u in text.split(mark) if u]


def _read(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Character codes, start and stop of each word (as ``str.split`` has them), and
    whether a unit ends with the word."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    inside = np.zeros(len(codes) + 2, bool)
    np.greater(codes, 32, out=inside[1:-1])
    # few characters are left to look up: control ones, and those from 0x85 on
    rare = np.flatnonzero((codes >= 0x85) | (codes < 32))
    inside[rare + 1] = ~_SPACE[np.minimum(codes[rare], len(_SPACE) - 1)]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[::2], edges[1::2]
    ends = np.zeros(len(stops), bool)
    if len(stops):
        # a break ends the unit of the word before it
        before = np.searchsorted(stops, np.flatnonzero(codes == 10), "right") - 1
        ends[before[before >= 0]] = True
        last = codes[stops - 1]
        stop = np.flatnonzero((last == 46) | (last == 33) | (last == 63))
        ends[stop[codes[np.minimum(stops[stop], len(codes) - 1)] == 32]] = True
        ends[-1] = True
    return codes, starts, stops, ends


def _read_each(texts: list[str]):
    """Start and stop of each word, and whether a unit ends with it, of each text; short
    texts are read side by side."""
    lo = 0
    while lo < len(texts):
        hi, chars = lo + 1, len(texts[lo])
        while hi < len(texts) and chars + len(texts[hi]) <= BATCH_CHARS:
            chars += len(texts[hi])
            hi += 1
        _, starts, stops, ends = _read("\n".join(texts[lo:hi]))
        after = np.cumsum([len(t) + 1 for t in texts[lo:hi]])
        cuts = np.append(0, np.searchsorted(starts, after)).tolist()
        for first, a, b in zip([0, *after.tolist()], cuts, cuts[1:]):
            yield starts[a:b] - first, stops[a:b] - first, ends[a:b]
        lo = hi


def _ends(ends: np.ndarray) -> np.ndarray:
    """The word counts up to each unit with a word, from 0."""
    return np.append(0, np.flatnonzero(ends) + 1)


def _word_hashes(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash of each word's characters, some BLOCK_CHARS characters at a time."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(stops, starts[lo] + BLOCK_CHARS, "right")))
        first, last = int(starts[lo]), int(stops[hi - 1])
        totals = _totals(codes[first:last].astype(np.uint64))
        out[lo:hi] = _runs(totals, starts[lo:hi] - first, stops[lo:hi] - first)
        lo = hi
    return out


def _words(texts: list[str]):
    """(word hashes uint64, word counts up to each unit) of each text."""
    lower = [t.lower() for t in texts]
    codes, starts, stops, ends = _read("\n".join(lower))
    hashes = _word_hashes(codes, starts, stops)
    after = np.cumsum([len(t) + 1 for t in lower])
    cuts = np.searchsorted(starts, after)
    for lo, hi in zip([0, *cuts[:-1].tolist()], cuts.tolist()):
        yield hashes[lo:hi], _ends(ends[lo:hi])


def _power(which: int, n: int) -> np.ndarray:
    """The first n powers of BASE (0) or of its inverse (1), modulo 2**64."""
    if len(_powers[which]) < n:
        steps = np.full(2 * n, pow(BASE, -1, 1 << 64) if which else BASE, np.uint64)
        steps[0] = 1
        _powers[which] = np.cumprod(steps, dtype=np.uint64)
    return _powers[which][:n]


def _forget() -> None:
    """A reused worker keeps no powers for the longest text that it has met."""
    _powers[:] = [np.ones(1, np.uint64)] * 2
    pa.default_memory_pool().release_unused()


def _mix(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _totals(hashes: np.ndarray) -> np.ndarray:
    """Running totals of hash times BASE to the power of its place, modulo 2**64."""
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * _power(0, len(hashes)), out=out[1:])
    return out


def _runs(totals: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hashes of the runs [start, stop): equal for equal words, wherever they stand."""
    return _mix((totals[stop] - totals[start]) * _power(1, len(totals))[start])


def _minima(mixed: np.ndarray, window: int) -> np.ndarray:
    """Positions of the window minima; the rightmost of equal ones."""
    w = min(window, len(mixed))
    views = np.lib.stride_tricks.sliding_window_view(mixed, w)
    right = w - 1 - views[:, ::-1].argmin(axis=1)
    at = np.arange(len(views)) + right          # never falls
    return at[np.append(True, at[1:] != at[:-1])]


def select(hashes: np.ndarray, gram: int = GRAM, window: int = WINDOW, totals=None
           ) -> tuple[np.ndarray, np.ndarray]:
    """(position, gram hash) of the selected grams."""
    n = len(hashes) - gram + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    starts = np.arange(n)
    totals = _totals(hashes.view(np.uint64)) if totals is None else totals
    mixed = _runs(totals, starts, starts + gram)
    at = _minima(mixed, window)
    return at, mixed[at].view(np.int64)


def unit_grams(ends: np.ndarray, min_words: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(start, stop) in words of the shortest runs of whole units of ``min_words`` words
    that begin, or end, with each unit."""
    last = np.searchsorted(ends, ends + min_words)
    first = np.searchsorted(ends, ends - min_words, "right") - 1
    ok, back = last < len(ends), first >= 0
    both = np.unique(np.concatenate([ends[ok] << 32 | ends[last[ok]],
                                     ends[first[back]] << 32 | ends[back]]))
    return both >> 32, both & LOW


def _slices(batch: pa.RecordBatch):
    """The batch in slices of about ``BATCH_CHARS`` characters."""
    lo, chars = 0, 0
    for i, n in enumerate(pc.utf8_length(batch[2]).to_pylist()):
        if chars and chars + n > BATCH_CHARS:
            yield batch.slice(lo, i - lo)
            lo, chars = i, 0
        chars += n
    yield batch.slice(lo)


def _places(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(fp, doc, place, length) rows of a batch of (doc, whole, value)."""
    lower = [t.lower() for t in batch[2].to_pylist()]
    codes, starts, stops, ends = _read("\n".join(lower))
    totals = _totals(_word_hashes(codes, starts, stops))
    # all texts side by side: text i has the words [cuts[i], cuts[i + 1])
    cuts = np.append(0, np.searchsorted(starts, np.cumsum([len(t) + 1 for t in lower])))
    start, stop = unit_grams(_ends(ends))
    doc = np.searchsorted(cuts, start, "right") - 1
    inside = stop <= cuts[doc + 1]
    start, stop, doc = start[inside], stop[inside], doc[inside]
    at, fp = _selected(totals, cuts)
    both = np.concatenate([start, at])
    docs = np.concatenate([doc, np.searchsorted(cuts, at, "right") - 1])
    # a word gram has no length: it is GRAM words
    lengths = np.concatenate([stop - start, np.zeros(len(at), np.int64)])
    whole = batch[1].to_numpy() & 0x7FFFFFFF
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([_runs(totals, start, stop).view(np.int64), fp])),
         batch[0].take(pa.array(docs)), pa.array(whole[docs] << 32 | (both - cuts[docs])),
         pa.array(lengths.astype(np.int32))],
        names=["fp", "doc", "place", "length"])


def _selected(totals: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``select`` for each of the texts that the words are cut into, with places among all."""
    n = max(0, len(totals) - GRAM)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    mixed = _mix((totals[GRAM:] - totals[:n]) * _power(1, n))
    grams = np.diff(cuts) - GRAM + 1
    # texts of one window at least; windows across texts have no minimum
    long = np.flatnonzero(grams >= WINDOW)
    change = np.zeros(len(mixed) + 1, np.int8)
    change[cuts[long]] = 1
    np.add.at(change, cuts[long] + grams[long] - WINDOW + 1, -1)
    chosen = _sides(np.where(np.cumsum(change[:-1]) > 0, _sides(mixed, np.minimum), 0),
                    np.maximum, back=True) == mixed
    chosen &= mixed > 0
    at = np.flatnonzero(chosen)
    # of equal minima the rightmost counts, which takes a look at each window
    ties = at[1:][(mixed[at[1:]] == mixed[at[:-1]]) & (np.diff(at) < WINDOW)]
    again = np.zeros(len(grams), bool)
    again[np.searchsorted(cuts, ties, "right") - 1] = True
    again[np.searchsorted(cuts, np.flatnonzero(mixed == 0), "right") - 1] = True
    again = (again & (grams > 0)) | ((grams > 0) & (grams < WINDOW))
    found = [at[~again[np.searchsorted(cuts, at, "right") - 1]]]
    for lo, n in zip(cuts[:-1][again].tolist(), grams[again].tolist()):
        found.append(lo + _minima(mixed[lo:lo + n], WINDOW))
    at = np.concatenate(found)
    return at, mixed[at].view(np.int64)


def _sides(x: np.ndarray, least, back: bool = False) -> np.ndarray:
    """``least`` (minimum or maximum) of the ``WINDOW`` neighbours from each place on, or up
    to it with ``back``; by doubling.  0 stands for what is beyond the ends."""
    edge = np.zeros(WINDOW - 1, x.dtype)
    x = np.concatenate([edge, x] if back else [x, edge])
    size = 1
    while size < WINDOW:
        step = min(size, WINDOW - size)
        x, size = least(x[:-step], x[step:]), size + step
    return x


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(fp, doc, place, length): grams; ``place`` is 31 bits of the text's hash and the
    number of the first word, ``length`` the words of a unit gram and 0 for a word gram."""
    source = (df.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("whole"),
                        F.col(text).alias("value"))
              .filter("doc IS NOT NULL AND value IS NOT NULL"))
    schema = T.StructType([T.StructField("fp", T.LongType()), source.schema["doc"],
                           T.StructField("place", T.LongType()),
                           T.StructField("length", T.IntegerType())])

    def run(batches):
        try:
            for b in batches:
                # many small batches would cost more than they save
                yield pa.concat_batches([_places(part) for part in _slices(b)])
        finally:
            _forget()
    return source.mapInArrow(run, schema)


def matches(prints: DataFrame) -> DataFrame:
    """(doc, part, start, stop): word intervals that stand earlier elsewhere too;
    ``part`` is the text hash's share of ``place``."""
    often = stored(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").select("fp"), "repeated-fingerprints")
    # one row a hash on this side: it fits a task's table, and the places need no sort
    places = stored(prints.join(often.hint("shuffle_hash"), "fp", "left_semi"), "repeated-places")
    # stored, so that the join's sides are plain exchanges, whose hot partitions Spark splits
    firsts = stored(places.groupBy("fp").agg(F.min(F.struct("doc", "place")).alias("first"))
                    .select("fp", *[F.col(f"first.{c}").alias(f"first_{c}")
                                    for c in ("doc", "place")]), "first-positions")
    part = F.shiftrightunsigned("place", 32)
    elsewhere = ((F.col("doc") != F.col("first_doc"))
                 | (part != F.shiftrightunsigned("first_place", 32)))
    later = (places.join(firsts.hint("shuffle_hash"), "fp")
             .filter(elsewhere | ((F.col("length") > 0)
                                  & (F.col("place") != F.col("first_place")))))
    start = F.col("place").bitwiseAND(F.lit(LOW)).cast("int")
    return later.select("doc", part.alias("part"), start.alias("start"),
                        (start + F.when(F.col("length") > 0, F.col("length")).otherwise(GRAM))
                        .alias("stop"), "first_doc",
                        F.shiftrightunsigned("first_place", 32).alias("first_part"),
                        F.col("first_place").bitwiseAND(F.lit(LOW)).cast("int")
                        .alias("first_start"))


def repeated_runs(found: DataFrame) -> DataFrame:
    """(doc, part, intervals) of documents with ``matches``: structs of start << 32 | stop
    (at), first_doc, first_part and first_start."""
    # rows equal in id and text give the same intervals: collect_set joins them
    at = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("stop").cast("long"))
    return found.groupBy("doc", "part").agg(F.collect_set(F.struct(
        at.alias("at"), "first_doc", "first_part", "first_start")).alias("intervals"))


def _joined(found: DataFrame, by: list[str], number: str) -> DataFrame:
    """``number``: the same for intervals [start, stop) of a group that meet or overlap."""
    order = Window.partitionBy(*by).orderBy("start")
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start") <= F.col("reach"), 0).otherwise(1)
    return (found.withColumn("reach", reach)
            .withColumn(number, F.sum(opens).over(order)).drop("reach"))


def segments(found: DataFrame) -> DataFrame:
    """(doc, part, run_start, run_stop, first_doc, first_part, shift, start, stop): ``matches``
    that meet or overlap at the same distance ``shift`` from the same holder, joined, and the
    run of words that all segments cover there."""
    doc = ["doc", "part"]
    beside = [*doc, "first_doc", "first_part", "shift"]
    # dealt by document alone: all that follows groups by more than that
    one = (_joined(found.withColumn("shift", F.col("start") - F.col("first_start"))
                   .select(*beside, "start", "stop").repartition(*doc), beside, "number")
           .groupBy(*beside, "number")
           .agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("number"))
    run = Window.partitionBy(*doc, "run")
    return _joined(one, doc, "run").select(
        *doc, F.min("start").over(run).alias("run_start"), F.max("stop").over(run).alias("run_stop"),
        "first_doc", "first_part", "shift", "start", "stop")


LEFT, RIGHT, HERE = 0, 1, 2     # sides of a segment; HERE: both, in its own document
WHOLE = 3                       # a run as it is


def edges(found: DataFrame) -> DataFrame:
    """(doc, part, at, side, shift, first_doc, first_part, place) of ``segments``: their runs,
    and the sides to extend with ``place``, as the holder is asked: word number << 1 | side."""
    here = (F.col("doc") == F.col("first_doc")) & (F.col("part") == F.col("first_part"))
    # nothing stands before a first word; inside a run extension adds nothing
    left = (~here & (F.col("start") > 0) & (F.col("start") > F.col("shift"))
            & (F.col("start") - EDGE < F.col("run_start")))
    right = ~here & (F.col("stop") + EDGE > F.col("run_stop"))
    side = F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in (
        (F.col("start") == F.col("run_start"), WHOLE), (here, HERE), (left, LEFT), (right, RIGHT))])))
    run = F.col("side") == WHOLE
    start, stop = (F.when(run, F.col(f"run_{c}")).otherwise(F.col(c)) for c in ("start", "stop"))
    at = F.shiftleft(start.cast("long"), 32).bitwiseOR(stop.cast("long"))
    word = F.when(F.col("side") == LEFT, F.col("start")).otherwise(F.col("stop")) - F.col("shift")
    place = F.when(F.col("side") < HERE, F.shiftleft(word.cast("long"), 1)
                   .bitwiseOR(F.col("side").cast("long")))
    return (found.withColumn("side", side)
            .select("doc", "part", at.alias("at"), "side",
                    F.when(run, 0).otherwise(F.col("shift")).alias("shift"), "first_doc",
                    "first_part", place.alias("place")))


def _beside(text: str, starts: np.ndarray, stops: np.ndarray, places) -> list[str]:
    """The words, in lower case, before or after each place."""
    out = []
    for place in places:
        word, side = place >> 1, place & 1
        lo, hi = (word, min(word + EDGE, len(starts))) if side else (max(0, word - EDGE), word)
        out.append(" ".join(text[starts[lo]:stops[hi - 1]].lower().split()) if lo < hi else "")
    return out


def contexts(rows: DataFrame, asked: DataFrame, text: str) -> DataFrame:
    """(key, place, words) for each of the ``asked`` (key, places) of the texts in ``rows``
    (row, key)."""
    # nullable as in the edges, so that the join takes this shuffle as it is
    key = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema["key"].dataType])
    schema = T.StructType([T.StructField("key", key), T.StructField("place", T.LongType()),
                           T.StructField("words", T.StringType())])

    def run(batches):
        last = None
        for b in batches:
            # rows equal in id and text stand side by side here: one of them is asked
            keys = b["key"].to_pylist()
            b = b.filter(pa.array([k != k0 for k, k0 in zip(keys, [last, *keys])]))
            last = keys[-1] if keys else last
            texts, places = b["row"].field(text).to_pylist(), b["places"]
            texts = [t or "" for t in texts]
            words = [_beside(t, starts, stops, p) for t, (starts, stops, _), p in
                     zip(texts, _read_each(texts), places.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b["key"].take(pc.list_parent_indices(places)), pc.list_flatten(places),
                 pa.array([w for some in words for w in some], pa.string())], names=schema.names)
    # the whole row goes along, so that both joins of the texts read one shuffle
    return rows.join(asked, "key").select("row", "key", "places").mapInArrow(run, schema)


def _shingles(spans, size: int) -> int:
    """Shingles of ``size`` words inside the union of the spans."""
    total, lo, hi = 0, 0, 0
    for a, b in sorted(spans):
        if a > hi:
            total, lo = total + max(0, hi - lo - size + 1), a
        hi = max(hi, b)
    return total + max(0, hi - lo - size + 1)


def best_source(at, source, first_start, size: int) -> tuple[int, int]:
    """(index of an interval, shingles): the source with most of the intervals' words, and
    the shingles that both have in common there, repeated ones counted once a place of the
    side that has fewer.  Intervals are start << 32 | stop, sources numbers."""
    found: dict = {}
    spans = zip((at >> 32).tolist(), (at & LOW).tolist(), source.tolist(), first_start.tolist())
    for i, (start, stop, s, first) in enumerate(spans):
        index, here, there = found.setdefault(s, (i, [], []))
        here.append((start, stop))
        there.append((first, first + stop - start))
    return max(((index, min(_shingles(here, size), _shingles(there, size)))
                for index, here, there in found.values()), key=lambda x: (x[1], -x[0]))


def near_copies(found: DataFrame, df: DataFrame, doc_id: str, text: str, percent: int,
                size: int) -> DataFrame:
    """(doc, part): documents that share ``percent`` percent of the union of
    shingles with one earlier document that has no repeated runs itself."""
    best_type = T.StructType([T.StructField("at", T.IntegerType()),
                              T.StructField("shared", T.LongType())])

    @F.pandas_udf(best_type)
    def best(at: pd.Series, source: pd.Series, first: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([best_source(*x, size) for x in zip(at, source, first)],
                            columns=best_type.names)
    source = F.transform("intervals", lambda x: F.xxhash64(x["first_doc"], x["first_part"]))
    chosen = (found.withColumn("best", best("intervals.at", source, "intervals.first_start"))
              .withColumn("from", F.get("intervals", F.col("best.at")))
              .select("doc", "part", F.col("best.shared").alias("shared"),
                      F.col("from.first_doc").alias("s_doc"),
                      F.col("from.first_part").alias("s_part")))
    lengths = (df.select(F.col(doc_id).alias("doc"),
                         F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).alias("part"),
                         F.greatest(F.regexp_count(text, F.lit(r"\S+")) - (size - 1), F.lit(0))
                         .alias("n"))
               .filter("doc IS NOT NULL AND n > 0").groupBy("doc", "part").agg(F.max("n").alias("n")))
    lengths = stored(lengths, "shingle-counts")
    sources = (lengths.join(found.select("doc", "part"), ["doc", "part"], "left_anti")
               .select(F.col("doc").alias("s_doc"), F.col("part").alias("s_part"),
                       F.col("n").alias("s_n")))
    return (chosen.join(lengths, ["doc", "part"]).join(sources, ["s_doc", "s_part"])
            .filter(100 * F.col("shared") >= percent * (F.col("n") + F.col("s_n")
                                                       - F.col("shared")))
            .select("doc", "part"))


def extend(text: str, at, side, shift, words) -> np.ndarray:
    """Runs and segments (start << 32 | stop), the latter with all equal words beside them: on
    the sides LEFT and RIGHT those that ``words`` names, HERE those at ``shift`` before."""
    out = at.tolist()
    if (side == WHOLE).all():
        return at
    own = text.lower().split()
    n = len(own)
    for k, (s, d, w) in enumerate(zip(side.tolist(), shift.tolist(), words)):
        lo, hi = out[k] >> 32, out[k] & LOW
        if s == HERE:
            while lo > max(d, 0) and own[lo - 1] == own[lo - 1 - d]:
                lo -= 1
            while hi < n and own[hi] == own[hi - d]:
                hi += 1
        elif s == LEFT and w:
            for other in reversed(w.split(" ")):
                if not lo or own[lo - 1] != other:
                    break
                lo -= 1
        elif s == RIGHT and w and hi < n:
            for other in w.split(" "):
                if hi >= n or own[hi] != other:
                    break
                hi += 1
        out[k] = lo << 32 | hi
    return np.array(out, np.int64)


def remove(text: str, intervals, min_words: int = MIN_WORDS, read=None
           ) -> tuple[str, int, int, int]:
    """(text left, runs, whole units, words removed): deletes the word runs that the
    intervals (start << 32 | stop) cover; ``read`` is the text's ``_read_each``."""
    starts, _, last = next(_read_each([text])) if read is None else read
    runs: list = []
    for at in sorted(intervals.tolist()):
        lo, hi = at >> 32, at & LOW
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(hi, runs[-1][1])
        else:
            runs.append([lo, hi])
    runs = [(lo, hi) for lo, hi in runs if hi - lo >= min_words]
    lost = sum(hi - lo for lo, hi in runs)
    if not runs:
        return text, 0, 0, 0
    ends = _ends(last)
    gone, kept, at = 0, [], 0
    for lo, hi in runs:
        gone += max(0, int(np.searchsorted(ends, hi, "right") - np.searchsorted(ends, lo)) - 1)
        start, stop = int(starts[lo]), int(starts[hi]) if hi < len(starts) else len(text)
        kept += [text[at:start], "\n" if "\n" in text[start:stop] else ""]
        at = stop
    left = "".join([*kept, text[at:]])
    return re.sub(r"\n{2,}", "\n", left).strip("\n"), len(runs), gone, lost


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
          spare_percent: int = 100, size: int = 5) -> DataFrame:
    """(row, removed): each row of ``df`` as a struct, its text without later repeated
    runs, and a struct of n_runs, n_units, n_words (long) that were removed.

    With ``spare_percent`` below 100, documents that are near-copies of one whole earlier
    document at that Jaccard similarity of ``size``-word shingles come back as they are."""
    # stored: they are read twice, and hashing texts costs more than reading them back
    found = matches(stored(fingerprints(df, doc_id, text), "fingerprints"))
    if spare_percent < 100:
        found = stored(found, "matches")
        runs = stored(repeated_runs(found), "repeated-runs")
        spared = near_copies(runs, df, doc_id, text, spare_percent, size)
        found = found.join(spared, ["doc", "part"], "left_anti")
    found = edges(stored(segments(found), "segments"))
    # the whole row rides along as one struct, so no column name can clash; the key is never
    # null, so that no join filters the rows before their shuffle
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"),
                     F.struct(F.col(doc_id).alias("doc"), F.xxhash64(text)
                              .bitwiseAND(F.lit(0x7FFFFFFF)).alias("part")).alias("key"))
    holder = F.struct(F.col("first_doc").alias("doc"), F.col("first_part").alias("part"))
    asked = (found.filter(F.col("place").isNotNull()).groupBy(holder.alias("key"))
             .agg(F.collect_set("place").alias("places")))
    beside = contexts(rows, asked, text).select(F.col("key").alias("holder"), "place", "words")
    found = (found.withColumn("holder", holder).join(beside, ["holder", "place"], "left")
             .groupBy(F.struct("doc", "part").alias("key"))
             .agg(F.collect_set(F.struct("at", "side", "shift", "words")).alias("edges")))
    out_type = T.StructType([T.StructField("text", T.StringType()),
                             *(T.StructField(c, T.LongType())
                               for c in ("n_runs", "n_units", "n_words"))])

    @F.pandas_udf(out_type)
    def cut(values: pd.Series, at: pd.Series, side: pd.Series, shift: pd.Series,
            words: pd.Series) -> pd.DataFrame:
        read = _read_each([v or "" for v in values])
        return pd.DataFrame(
            [(None, 0, 0, 0) if v is None else remove(v, extend(v, *some), read=one)
             for one, v, *some in zip(read, values, at, side, shift, words)],
            columns=out_type.names)
    value = F.col("row")[text]
    done = (rows.join(found, "key", "left")
            .select("row", cut(F.when(F.col("edges").isNotNull(), value), "edges.at",
                               "edges.side", "edges.shift", "edges.words").alias("cut")))
    return done.select(
        F.col("row").withField(text, F.coalesce("cut.text", value)).alias("row"),
        F.struct("cut.n_runs", "cut.n_units", "cut.n_words").alias("removed"))
