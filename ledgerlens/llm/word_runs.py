"""Periodic runs of words, by a difference cover and a harmonic grid.

A run is a stretch of words that repeats itself with a smallest period q: words q
apart are equal, it has ``max(MIN_LENGTH, EXPONENT * q)`` words at least, and neither
neighbour extends it.  All runs of a text are found, exactly:

* Grid.  The pairs (i, i + q) of a run of period q fill ``(EXPONENT - 1) * q``
  neighbouring places i at least, so for each q it is enough to look at every
  ``(EXPONENT - 1) * q``-th place: a harmonic number of pairs in all.  Nearly all of
  them hold two different words and are done with.
* Longest common extensions.  For each pair that is left, how far the text goes on
  alike from both places, to the right and (on the text read backwards) to the left.
  Only suffixes at places of a difference cover modulo ``MODULUS`` are sorted, a fifth
  of all, by prefix doubling in steps of the modulus.  Any two places reach a pair of
  sampled ones within ``MODULUS`` words; so many words are compared, and the rest is
  the minimum of a range of the sampled suffixes' common prefixes (sparse table).
* A run found with several periods has the smallest of them.

Plan: row-parallel, one pass, no shuffle.  Texts are taken in slices of about
``SLICE_CHARS`` characters; a slice is one array of word numbers with a word of its own
after each text, so that no extension leaves its text.  Memory follows the slice, or
the longest text if that is longer.

Defined results: words are what stands between white space (``\\x20 \\x09-\\x0D``); a
null or blank text has no words, no runs and an empty collapsed text; equal rows get
equal results; columns not named are not read, so clashing names do no harm; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

MIN_LENGTH = 6
EXPONENT = 4               # a run has its period so many times at least
SLICE_CHARS = 1 << 20
PAIRS = 1 << 14            # pairs whose words are compared side by side

# A perfect difference set, any residue is a difference of two of them.
MODULUS = 31
COVER = (0, 1, 3, 8, 12, 18)

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def _shifts() -> np.ndarray:
    """[a, b]: the smallest d for which a + d and b + d both are in the cover."""
    inside = np.zeros(MODULUS, bool)
    inside[list(COVER)] = True
    d = np.arange(MODULUS)
    a, b, d = d[:, None, None], d[None, :, None], d[None, None, :]
    both = inside[(a + d) % MODULUS] & inside[(b + d) % MODULUS]
    return both.argmax(axis=2)


SHIFTS = _shifts()


class Extensions:
    """Longest common extensions to the right in an array of word numbers.

    No two suffixes may be equal and none a prefix of another: the last number must
    occur nowhere else."""

    def __init__(self, words: np.ndarray):
        self.n = len(words)
        blocks = -(-self.n // MODULUS) + 1
        # behind the end stands a number that no word has
        self.words = np.full((blocks + 2) * MODULUS, -1, np.int32)
        self.words[:self.n] = words
        self.slot = np.full(MODULUS, -1, np.int64)
        self.slot[list(COVER)] = np.arange(len(COVER))
        places = (np.arange(blocks)[:, None] * MODULUS + np.array(COVER)).ravel()
        self.places = places[places < self.n]
        self._sort()
        self._prefixes()

    def _sample(self, places: np.ndarray) -> np.ndarray:
        return places // MODULUS * len(COVER) + self.slot[places % MODULUS]

    def _sort(self) -> None:
        """Ranks of the sampled suffixes by MODULUS words, then twice as many, ..."""
        m = len(self.places)
        windows = np.lib.stride_tricks.sliding_window_view(self.words, MODULUS)[self.places]
        flat = np.ascontiguousarray(windows).view(f"V{4 * MODULUS}").ravel()
        _, rank = np.unique(flat, return_inverse=True)
        self.levels, step = [rank.astype(np.int32)], len(COVER)
        while int(self.levels[-1].max(initial=0)) + 1 < m:
            last = self.levels[-1].astype(np.int64)
            after = np.zeros(m, np.int64)                   # 0: nothing follows
            after[:max(0, m - step)] = last[step:] + 1
            _, rank = np.unique(last * (m + 1) + after, return_inverse=True)
            self.levels.append(rank.astype(np.int32))
            step *= 2
        self.rank = self.levels[-1]

    def _prefixes(self) -> None:
        """Common prefix of each sampled suffix with the one before it in order, and
        the minima of ranges of 1, 2, 4, ... of them."""
        order = np.empty(len(self.rank), np.int64)
        order[self.rank] = np.arange(len(order))
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        for k in range(len(self.levels) - 2, -1, -1):       # all differ on the last level
            rank, step = self.levels[k], len(COVER) << k
            inside = (a < len(rank)) & (b < len(rank))
            same = inside.copy()
            same[inside] = rank[a[inside]] == rank[b[inside]]
            common += np.where(same, MODULUS << k, 0)
            a, b = a + same * step, b + same * step
        start = self.places[order]
        common += self._compare(start[:-1] + common, start[1:] + common, MODULUS)
        self.levels = None
        self.table = [common]
        width = 1
        while 2 * width <= len(common):
            t = self.table[-1]
            self.table.append(np.minimum(t[:-width], t[width:]))
            width *= 2

    def _compare(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Equal words from both places on, ``most`` at most."""
        out = np.empty(len(a), np.int64)
        steps = np.arange(most)
        for lo in range(0, len(a), PAIRS):
            x, y = a[lo:lo + PAIRS, None] + steps, b[lo:lo + PAIRS, None] + steps
            end = len(self.words) - 1
            differ = self.words[np.minimum(x, end)] != self.words[np.minimum(y, end)]
            out[lo:lo + PAIRS] = np.where(differ.any(axis=1), differ.argmax(axis=1), most)
        return out

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of equal words from a and from b on (a and b differ)."""
        shift = SHIFTS[a % MODULUS, b % MODULUS]
        near = self._compare(a, b, MODULUS)
        out = np.minimum(near, shift)
        far = near >= shift
        x, y = self._sample(a[far] + shift[far]), self._sample(b[far] + shift[far])
        lo, hi = self.rank[x].astype(np.int64), self.rank[y].astype(np.int64)
        lo, hi = np.minimum(lo, hi), np.maximum(lo, hi)
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        rest = np.empty(len(lo), np.int64)
        for k in np.unique(level):
            at = level == k
            t = self.table[k]
            rest[at] = np.minimum(t[lo[at]], t[hi[at] - (1 << int(k))])
        out[far] += rest
        return out


def _pairs(words: np.ndarray, text_of: np.ndarray, longest: int):
    """(place, period) arrays of the grid's pairs of equal words inside one text."""
    n = len(words)
    for q in range(1, longest // EXPONENT + 1):
        step = (EXPONENT - 1) * q
        at = np.flatnonzero(words[:n - q:step] == words[q::step]) * step
        if len(at):
            at = at[text_of[at] == text_of[at + q]]
            yield at, np.full(len(at), q)


def find_runs(words: np.ndarray, lengths: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``words`` are the texts' word numbers (from 0) one text after the other."""
    lengths = np.asarray(lengths, np.int64)
    stops = np.cumsum(lengths)
    text_of = np.repeat(np.arange(len(lengths)), lengths)
    found = [(at, q) for at, q in _pairs(words, text_of, int(lengths.max(initial=0)))
             if len(at)]
    none = tuple(np.empty(0, np.int64) for _ in range(4))
    if not found:
        return none
    at, q = (np.concatenate(x) for x in zip(*found))
    # both neighbours alike to the right, or to the left, or one each: a run has three
    # equal pairs in a row at least; few other pairs have
    first, last = (stops - lengths)[text_of[at]], stops[text_of[at]]

    def equal(shift):
        ok = (at + shift >= first) & (at + shift + q < last)
        i = np.where(ok, at + shift, 0)
        return ok & (words[i] == words[np.where(ok, i + q, 0)])
    right, left = equal(1), equal(-1)
    ok = (right & equal(2)) | (left & equal(-2)) | (right & left)
    at, q = at[ok], q[ok]
    if not len(at):
        return none
    # the texts with pairs left, each between two numbers that occur once
    texts = np.unique(text_of[at])
    sizes = lengths[texts]
    begins = np.cumsum(sizes + 1) - sizes
    joined = np.empty(int(sizes.sum()) + len(texts) + 1, np.int64)
    number = int(words.max()) + 1
    joined[0] = number
    for k, (t, size, begin) in enumerate(zip(texts, sizes.tolist(), begins.tolist())):
        joined[begin:begin + size] = words[stops[t] - size:stops[t]]
        joined[begin + size] = number + 1 + k
    which = np.searchsorted(texts, text_of[at])
    place = at - first[ok] + begins[which]
    forward, backward = Extensions(joined), Extensions(joined[::-1])
    end = len(joined) - 1
    starts, ends, periods, owners = [], [], [], []
    for lo in range(0, len(place), PAIRS):
        i, p, w = place[lo:lo + PAIRS], q[lo:lo + PAIRS], which[lo:lo + PAIRS]
        right = forward.of(i, i + p)
        left = backward.of(end - i + 1, end - i - p + 1)
        long = right + left + p >= np.maximum(MIN_LENGTH, EXPONENT * p)
        starts.append((i - left - begins[w])[long])
        ends.append((i + right + p - begins[w])[long])
        periods.append(p[long])
        owners.append(w[long])
    start, stop, period, owner = (np.concatenate(x) for x in (starts, ends, periods, owners))
    order = np.lexsort((period, stop, start, owner))
    start, stop, period, owner = start[order], stop[order], period[order], owner[order]
    new = np.ones(len(start), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period, owner = start[new], stop[new], period[new], owner[new]
    order = np.lexsort((period, start, owner))
    return texts[owner[order]], start[order], (stop - start)[order], period[order]


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _slices(column: pa.Array):
    """Row numbers and texts, about SLICE_CHARS characters at a time."""
    first, held, size = 0, [], 0
    for value in column:
        held.append(value.as_py() or "")
        size += len(held[-1])
        if size >= SLICE_CHARS:
            yield first, held
            first, held, size = first + len(held), [], 0
    if held:
        yield first, held


def analyse(texts: list[str], arrange: Callable | None = None, keys=()):
    """(words, runs [(start, length, period)], collapsed text) of each text.

    ``arrange(key, n)`` may give the n word places in another order, or None."""
    numbers, numbered, words, lengths = _Numbers(), [], [], []
    for k, text in enumerate(texts):
        own = text.encode("utf-8").split()
        ids = np.fromiter(map(numbers.__getitem__, own), np.int64, len(own))
        order = arrange(keys[k], len(own)) if arrange is not None else None
        if order is not None:
            ids, own = ids[order], [own[i] for i in order.tolist()]
        numbered.append(ids)
        words.append(own)
        lengths.append(len(own))
    flat = np.concatenate([np.empty(0, np.int64), *numbered])
    text, start, length, period = find_runs(flat, np.array(lengths))
    cuts = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
    for k, own in enumerate(words):
        lo, hi = cuts[k], cuts[k + 1]
        runs = list(zip(start[lo:hi].tolist(), length[lo:hi].tolist(), period[lo:hi].tolist()))
        if runs:
            gone = np.zeros(len(own) + 1, np.int32)
            np.add.at(gone, start[lo:hi] + period[lo:hi], 1)
            np.add.at(gone, start[lo:hi] + length[lo:hi], -1)
            own = [own[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
        yield lengths[k], runs, b" ".join(own).decode("utf-8")


def detect(df: DataFrame, text: str = "text", keep=("doc_id",),
           arrange: Callable | None = None) -> DataFrame:
    """keep columns, n_words long, runs array<struct<start, length, period>> by start and
    period, collapsed string: the text's words joined by one space, without those that a
    run holds after its first period.

    ``arrange(first kept value, n)``: see ``analyse``."""
    source = df.select(*keep, F.col(text).alias("__value"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)),
                           T.StructField("collapsed", T.StringType())])
    names = schema.names
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        for b in batches:
            for first, texts in _slices(b.columns[-1]):
                kept = [c.slice(first, len(texts)) for c in b.columns[:-1]]
                keys = kept[0].to_pylist() if arrange is not None else ()
                counts, runs, left = zip(*analyse(texts, arrange, keys))
                runs = [[dict(zip(RUN.names, r)) for r in rs] for rs in runs]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *map(pa.array, (counts, runs, left), kinds[-3:])], names=names)
    return source.mapInArrow(run, schema)


def strongest(runs):
    """The run of greatest length over period, ties to the smallest start, then period;
    ``runs`` is a column as ``detect`` returns it, null if it is empty."""
    return F.aggregate(
        runs, F.get(runs, F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r)
        .otherwise(best))
