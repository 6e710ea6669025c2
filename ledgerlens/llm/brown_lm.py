"""Scoring by a Brown class-based bigram model, learnt from a part of the documents.

A text is the tokens of its words and one end token.  Each word has one class; a token's
probability is that of its class after the previous token's class (after the end for the
first one), times that of the word among the words of its class.

Classes.  A word that is at least one of ``SHARE`` learnt tokens is frequent: there are
``SHARE`` such words at most, however large the corpus.  They are put into ``CLASSES``
classes by exchange clustering: a word moves to the class in which the likelihood of all
learnt class bigrams is largest, given the classes of its neighbours.  The end is a class.
Every other word starts in the class of its last letter, or of having a digit.  Then each
learnt one is placed by all of its own neighbours: it takes the exchanged class in which
its learnt tokens are most likely under the exchanged bigrams, if that is more than in the
class of its shape.  An unseen word has its shape's class, and so has a word seen once:
without its one token, it would be unseen, and it is from such words that the probability
of unseen ones is learnt.

Exchange runs as Spark jobs over the table of bigrams (frequent words by themselves, other
words by class): a round sums, for each word, the classes before and after it, and weighs
each of its possible moves with the class bigram matrix, of a fixed size.  Words move at
the same time, half of them in a round, by turns; the likelihood is measured after each
round.  It ends when two rounds add less than ``TOLERANCE`` nats a token, or when a round
loses, which is then undone; each pair of rounds gains more than that, so it does end.

Smoothing.  A class follows a class with (count + BACKOFF * its share of tokens) / (count of
the first + BACKOFF).  Among the words of a class by shape the share of those seen
once is left for the unseen, which count as one word.  The base score is the
unigram model that adds 0.1.

Plan.  Texts are numbered once, in chunks of about ``CHUNK_CHARS`` characters, each with its
own vocabulary; a chunk's tokens are stored as numbers, long words as digests.  From then on
a word moves once per chunk, not once per token: to its count, and to be placed, together
with the classes beside its tokens there (two bytes a token of an infrequent word), and from
there back to its chunk, where texts become class sequences.  A chunk's words move as one row
for each group of words by hash; a group has ``GROUP_WORDS`` words of chunks, so that there are
more groups in larger tables.  These are stored; the last
bigram matrix is counted from them, then they are scored.  Bigrams are summed inside the
task before they are shuffled.  Broadcast are only the frequent words and the matrix.

Defined results: words are cut at white space (``\\x20 \\x09-\\x0D``), A-Z in lower case; a
null or blank text has the end token alone; equal rows count, and come back, once each;
rows whose ``learn`` is null are not learnt from; without anything to learn, all words are
unseen ones; the kept columns come back in one struct, whatever their names; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ledgerlens.llm.scratch import stored

CLASSES = 64
SHARE = 20_000
TOLERANCE = 0.002
BACKOFF = 10.0
ADD = 0.1                  # fixed value: what the base score adds to each count
CHUNK_CHARS = 4 << 20
SLICE_CHARS = 1 << 20
HELD_PAIRS = 1 << 20       # distinct bigrams that a task holds
KEY_BYTES = 64             # longer words move as a digest
PARTS = 64                 # groups in which the words' moves are weighed
GROUP_WORDS = 1 << 18      # words of chunks that are placed side by side

# Class numbers: last letters, digits, the end, then the exchanged classes.
LETTERS = 32
DIGITS = LETTERS
END = DIGITS + 1
FIRST = END + 1


_DIGIT = re.compile("[0-9]").search


def shape_class(word: str) -> int:
    """The class of a word by its shape."""
    return DIGITS if _DIGIT(word) else ord(word[-1]) % LETTERS


def shape_column(word) -> Column:
    """``shape_class`` as a column."""
    w = F.col(word)
    return F.when(w.rlike("[0-9]"), F.lit(DIGITS)).otherwise(
        F.ascii(F.right(w, F.lit(1))) % LETTERS).cast("int")


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


_HEX_LETTERS = bytes.maketrans(b"0123456789abcdef", b"ghijklmnopabcdef")


def word_key(word: bytes) -> str:
    """What stands for a word in tables: itself, or for a long one a digest of the same
    shape class, marked by a blank, which no word has."""
    if len(word) <= KEY_BYTES:
        return word.decode("utf-8")
    text = word.decode("utf-8")
    digest = hashlib.sha256(word).hexdigest().encode().translate(_HEX_LETTERS).decode()
    return f" {digest}{'0' if shape_class(text) == DIGITS else ''}{text[-1]}"


def pack_numbers(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte: all lowest bytes, all second ones, ...  Most upper
    bytes are 0 then stand side by side, and compress."""
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, numbers.itemsize).T).tobytes()


def unpack_numbers(packed: bytes, kind: str = "<i4") -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _slices(batch: pa.RecordBatch):
    """The batch in slices of about SLICE_CHARS characters of its last column."""
    lo, chars = 0, 0
    for i, n in enumerate(pc.utf8_length(batch.columns[-1]).to_pylist()):
        if chars and chars + (n or 0) > SLICE_CHARS:
            yield batch.slice(lo, i - lo), chars
            lo, chars = i, 0
        chars += n or 0
    if lo < len(batch):
        yield batch.slice(lo), chars


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def numbered(docs: DataFrame, keep, text: str, learn: Column) -> DataFrame:
    """Chunks: a row per document (chunk, place in it, row struct of the kept columns, learn)
    and one per chunk (chunk, words, counts: learnt tokens; by place of the documents: tokens
    binary, see pack_numbers, of all of them, lengths, learnt)."""
    source = docs.select(F.struct(*keep).alias("row"), F.coalesce(learn, F.lit(False))
                         .alias("learn"), F.col(text).alias("value"))
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("place", T.IntegerType()),
        T.StructField("row", source.schema["row"].dataType),
        T.StructField("learn", T.BooleanType()),
        T.StructField("words", T.ArrayType(T.StringType())),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("tokens", T.BinaryType()),
        T.StructField("lengths", T.ArrayType(T.IntegerType())),
        T.StructField("learnt", T.ArrayType(T.BooleanType()))])
    kinds = [to_arrow_type(f.dataType) for f in schema.fields]

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32
        numbers, tokens, learnt, chars = _Numbers(), [], [], 0

        def vocabulary():
            counts = np.bincount(np.concatenate([np.zeros(0, np.int64), *(
                t for t, ok in zip(tokens, learnt) if ok)]).astype(np.int64), minlength=len(numbers))
            columns = [[word_key(w) for w in numbers], counts, pack_numbers(np.concatenate(tokens)),
                       np.array([len(t) for t in tokens], np.int32), learnt]
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk]), *(pa.nulls(1, k) for k in kinds[1:4]),
                 *(pa.array([c], k) for c, k in zip(columns, kinds[4:]))], names=schema.names)
        for b in batches:
            for part, size in _slices(b):
                first, n = len(tokens), len(part)
                tokens += [np.fromiter(map(numbers.__getitem__, w), "<i4", len(w))
                           for w in map(_words, part.columns[2].to_pylist())]
                learnt += part.columns[1].to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, chunk)), pa.array(np.arange(first, first + n, dtype=np.int32)),
                     part.columns[0], part.columns[1], *(pa.nulls(n, k) for k in kinds[4:])],
                    names=schema.names)
                chars += size
                if chars >= CHUNK_CHARS:
                    yield vocabulary()
                    chunk, chars = chunk + 1, 0
                    numbers, tokens, learnt = _Numbers(), [], []
        if tokens:
            yield vocabulary()
    return source.mapInArrow(run, schema)


def bigrams(docs: DataFrame, text: str, learn: Column, number: dict[str, int]) -> DataFrame:
    """(a, b, n): learnt pairs of neighbouring tokens, words whose key is not in ``number``
    by class."""
    shared = docs.sparkSession.sparkContext.broadcast(number)
    source = docs.filter(learn).select(F.col(text).alias("value"))

    class Ids(dict):
        def __missing__(self, word):
            key = word_key(word)
            n = shared.value.get(key)
            self[word] = n = shape_class(key) if n is None else n
            return n

    def run(batches):
        codes, sums = np.empty(0, np.int64), np.empty(0, np.int64)

        def out():
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums)],
                                              names=["code", "n"])
        for b in batches:
            for part, _ in _slices(b):
                ids, flat = Ids(), [np.array([END])]
                for w in map(_words, part.columns[0].to_pylist()):
                    flat += [np.fromiter(map(ids.__getitem__, w), np.int64, len(w)), [END]]
                flat = np.concatenate(flat).astype(np.int64)
                new, n = np.unique(flat[:-1] << 32 | flat[1:], return_counts=True)
                both, at = np.unique(np.concatenate([codes, new]), return_inverse=True)
                sums = np.bincount(at, np.concatenate([sums, n]), len(both)).astype(np.int64)
                codes = both
                if len(codes) > HELD_PAIRS:
                    yield out()
                    codes, sums = codes[:0], sums[:0]
        if len(codes):
            yield out()
    return (source.mapInArrow(run, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n"))
            .select(F.shiftright("code", 32).cast("int").alias("a"),
                    F.col("code").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("b"), "n"))


def _xlogx(x):
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(matrix: np.ndarray) -> float:
    """What the classes contribute to the log likelihood of the learnt tokens, in nats."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(axis=1)).sum()
                 - _xlogx(matrix.sum(axis=0)).sum())


def best_moves(word, side, other, n, own, matrix) -> np.ndarray:
    """The best class of each word 0..len(own)-1, from sorted rows (word, side, class, n):
    n bigrams of the word with the class after it (side 0) or before it (side 1).  A word
    is taken out of its own class before it is weighed there; of equal classes its own
    holds, then the first."""
    gain = np.zeros((len(own), len(matrix) - FIRST))
    columns = np.arange(FIRST, len(matrix))
    for s, m in ((0, matrix), (1, matrix.T)):
        at = side == s
        w, c, k = word[at], other[at], n[at].astype(np.float64)
        for lo in range(0, len(w), 1 << 14):
            x, y, z = w[lo:lo + (1 << 14)], c[lo:lo + (1 << 14)], k[lo:lo + (1 << 14), None]
            there = m[columns[None, :], y[:, None]]
            there = there - (columns[None, :] == own[x][:, None]) * z
            np.add.at(gain, x, _xlogx(np.maximum(there, 0) + z) - _xlogx(np.maximum(there, 0)))
    size = np.bincount(word[side == 0], n[side == 0], len(own))[:, None]
    total = matrix.sum(axis=1)[FIRST:][None, :] - (columns[None, :] == own[:, None]) * size
    gain -= 2 * (_xlogx(np.maximum(total, 0) + size) - _xlogx(np.maximum(total, 0)))
    best = gain.argmax(axis=1)
    rows = np.arange(len(own))
    stay = gain[rows, own - FIRST] >= gain[rows, best] - 1e-9
    return np.where(stay, own, best + FIRST)


def exchange(pairs: DataFrame, words: int, classes: int = CLASSES,
             tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """(class of each frequent word, class bigram matrix, likelihood after each round).

    ``pairs`` (a, b, n) is a stored table; frequent words have numbers from FIRST on, by
    falling frequency."""
    spark = pairs.sparkSession
    size = FIRST + classes
    # the most frequent words start alone, all others together
    own = FIRST + np.minimum(np.arange(words), classes - 1)

    def contexts(own):
        every = np.concatenate([np.arange(FIRST), own])
        table = F.broadcast(spark.createDataFrame(pd.DataFrame(
            {"other": np.arange(len(every), dtype=np.int32), "class": every.astype(np.int32)})))
        both = (pairs.select(F.lit(0).alias("side"), F.col("a").alias("word"),
                             F.col("b").alias("other"), "n")
                .union(pairs.select(F.lit(1), "b", "a", "n")))
        found = stored(both.join(table, "other").groupBy("word", "side", "class")
                       .agg(F.sum("n").alias("n")), "class-contexts")
        cells = (found.filter("side = 0").join(table.select(
            F.col("other").alias("word"), F.col("class").alias("first")), "word")
            .groupBy("first", "class").agg(F.sum("n").alias("n")).collect())  # size * size
        matrix = np.zeros((size, size))
        for r in cells:
            matrix[r["first"], r["class"]] = r["n"]
        return found, matrix

    found, matrix = contexts(own)
    tokens, scores, turn = max(1.0, matrix.sum()), [likelihood(matrix)], 0
    while words:
        shared = spark.sparkContext.broadcast((own, matrix))

        def weigh(pdf: pd.DataFrame) -> pd.DataFrame:
            all_own, m = shared.value
            ids, word = np.unique(pdf["word"].to_numpy(), return_inverse=True)
            new = best_moves(word, pdf["side"].to_numpy(), pdf["class"].to_numpy(),
                             pdf["n"].to_numpy(), all_own[ids - FIRST], m)
            return pd.DataFrame({"word": ids, "class": new})
        half = F.pmod(F.xxhash64("word"), F.lit(2)) == turn % 2
        moves = (found.filter((F.col("word") >= FIRST) & half)
                 .groupBy(F.pmod(F.xxhash64("word", F.lit(7)), F.lit(PARTS)).alias("part"))
                 .applyInPandas(weigh, "word long, class long").collect())   # SHARE rows at most
        new = own.copy()
        for r in moves:
            new[r["word"] - FIRST] = r["class"]
        later, later_matrix = contexts(new)
        score = likelihood(later_matrix)
        if score < scores[-1]:
            break
        own, found, matrix = new, later, later_matrix
        scores.append(score)
        turn += 1
        if turn % 2 == 0 and scores[-1] - scores[-3] < tolerance * tokens:
            break
    return own, matrix, scores


@dataclass
class Model:
    """What scoring a chunk needs: fixed in size by the number of classes."""

    matrix: np.ndarray          # learnt class bigrams
    once: np.ndarray            # words seen once, by class
    tokens: int                 # N
    types: int                  # V
    ends: int                   # learnt end tokens

    def __post_init__(self):
        self.size = self.matrix.sum(axis=1)             # tokens of each class
        share = (self.size + ADD) / (self.size.sum() + ADD * len(self.size))
        self.follow = np.log10((self.matrix + BACKOFF * share) / (self.size[:, None] + BACKOFF))
        # the end is its class's only word; frequent words are all known
        unseen = (self.once + 0.5) / (self.size + 1)
        unseen[END:] = 0
        self.known, self.unseen = np.log10(1 - unseen), unseen

    def emission(self, count: np.ndarray, of: np.ndarray) -> np.ndarray:
        """log10 probability of words among their class's."""
        out = np.log10(np.maximum(self.unseen[of], 1e-300))
        seen = count > 0
        c = of[seen]
        out[seen] = np.log10(count[seen] / np.maximum(self.size[c], 1)) + self.known[c]
        return out

    def base(self, count):
        return np.log10((count + ADD) / (self.tokens + ADD * (self.types + 1)))


def _bytes(codes: int):
    """The type of a code among that many."""
    return np.dtype("u1" if codes <= 1 << 8 else "<u2")


def _with_ends(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The texts' tokens with -1, the end, after each text."""
    flat = np.full(len(tokens) + len(lengths), -1, np.int64)
    inner = np.ones(len(flat), bool)
    inner[np.cumsum(lengths + 1) - 1] = False
    flat[inner] = tokens
    return flat


def neighbours(of: np.ndarray, order: np.ndarray, tokens: np.ndarray, lengths: np.ndarray,
               learnt: np.ndarray, size: int) -> np.ndarray:
    """Pairs of the classes before and after each infrequent token in the learnt texts of a
    chunk, in the given order of the words; ``of`` has the words' classes."""
    flat = _with_ends(tokens, lengths)[np.repeat(learnt, lengths + 1)]
    classes = np.append(of, END)[flat]
    at = np.flatnonzero(classes < END)
    at = at[np.argsort(np.argsort(order)[flat[at]], kind="stable")]
    # a text's first token stands after an end, and no text's last token is a word
    pairs = np.stack([np.where(at > 0, classes[at - 1], END), classes[at + 1 if len(at) else at]], 1)
    return pairs.astype(_bytes(size))


def contexts(chunks: DataFrame, known: dict[str, int], size: int, groups: int) -> DataFrame:
    """(part, chunk, words, ids, n, pairs) per chunk and group of words by hash: the words, one
    a line, their numbers and learnt tokens packed, and the ``neighbours`` of infrequent ones."""
    shared = chunks.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for b in batches:
            for i in range(len(b)):
                words, n = b["words"][i].as_py(), b["counts"][i].values.to_numpy().astype("<i8")
                of = np.array([shared.value.get(w) or shape_class(w) for w in words], np.int64)
                part = np.array([zlib.crc32(w.encode()) % groups for w in words], np.int64)
                order = np.argsort(part, kind="stable")
                pairs = neighbours(of, order, unpack_numbers(b["tokens"][i].as_py()),
                                   b["lengths"][i].values.to_numpy().astype(np.int64),
                                   np.array(b["learnt"][i].as_py(), bool), size)
                part, n = part[order], n[order]
                stops = np.append(0, np.cumsum(np.where(of[order] < END, n, 0)))
                cuts = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])[:len(part)]),
                                 len(part)).tolist()
                rows = [(int(part[lo]), b["chunk"][i].as_py(),
                         "\n".join([words[k] for k in order[lo:hi].tolist()]),
                         pack_numbers(order[lo:hi].astype("<i4")), pack_numbers(n[lo:hi]),
                         pairs[stops[lo]:stops[hi]].tobytes()) for lo, hi in zip(cuts, cuts[1:])]
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), (
                            pa.int32(), pa.int64(), pa.string(), *[pa.binary()] * 3))],
                        names=["part", "chunk", "words", "ids", "n", "pairs"])
    return (chunks.select("chunk", "words", "counts", "tokens", "lengths", "learnt")
            .mapInArrow(run, "part int, chunk long, words string, ids binary, n binary, pairs binary"))


def place(model: Model, word: np.ndarray, pairs: np.ndarray, own: np.ndarray,
          count: np.ndarray) -> np.ndarray:
    """The class of each word 0..len(own)-1, now in ``own``, with ``count`` learnt tokens: the
    one in which these are most likely between the classes beside them, rows of ``pairs`` of
    the sorted ``word``; its own, if no exchanged class is better."""
    # whole numbers, so that sums do not depend on the order of rows
    follow = np.rint(model.follow * (1 << 24))
    before, after = follow[:, FIRST:], np.ascontiguousarray(follow[FIRST:].T)
    gain = np.zeros((len(own), before.shape[1]))
    for lo in range(0, len(word), 1 << 12):
        w, p = word[lo:lo + (1 << 12)], pairs[lo:lo + (1 << 12)]
        first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
        gain[w[first]] += np.add.reduceat(before[p[:, 0]] + after[p[:, 1]], first, axis=0)
    here = own[word]
    stay = np.bincount(word, follow[pairs[:, 0], here] + follow[here, pairs[:, 1]], len(own))
    stay = stay / (1 << 24) - count * np.log10(np.maximum(model.size[own], 1))
    gain = gain / (1 << 24) - count[:, None] * np.log10(model.size[FIRST:] + count[:, None])
    best = gain.argmax(axis=1)
    return np.where(gain[np.arange(len(own)), best] > stay + 1e-9, best + FIRST, own)


def placed(found: DataFrame, model: Model, known: dict[str, int]) -> DataFrame:
    """(of_chunk, ids, c, class) per row of ``contexts``: the words' learnt tokens in all and
    classes, packed."""
    shared = found.sparkSession.sparkContext.broadcast((model, known))
    kind = _bytes(len(model.matrix))

    def classes(b: pa.Table) -> pa.Table:
        model, known = shared.value
        lists = [w.split("\n") for w in b["words"].to_pylist()]
        keys = pa.array([w for some in lists for w in some], pa.string()).dictionary_encode()
        word, words = keys.indices.to_numpy(), keys.dictionary.to_pylist()
        n = np.concatenate([unpack_numbers(x, "<i8") for x in b["n"].to_pylist()])
        count = np.zeros(len(words), np.int64)
        np.add.at(count, word, n)
        of = np.array([known.get(w) or shape_class(w) for w in words], np.int64)
        at = np.repeat(word, np.where(of[word] < END, n, 0))
        pairs = np.frombuffer(b"".join(b["pairs"].to_pylist()), kind).reshape(-1, 2)
        rows = np.argsort(at, kind="stable")
        rows = rows[count[at[rows]] > 1]
        which, at = np.unique(at[rows], return_inverse=True)
        of[which] = place(model, at, pairs[rows], of[which], count[which])
        cuts = np.cumsum([0, *map(len, lists)]).tolist()
        count, of = count[word], of[word].astype(kind)
        return pa.table({
            "of_chunk": b["chunk"], "ids": b["ids"],
            "c": pa.array([pack_numbers(count[lo:hi]) for lo, hi in zip(cuts, cuts[1:])], pa.binary()),
            "class": pa.array([of[lo:hi].tobytes() for lo, hi in zip(cuts, cuts[1:])], pa.binary())})
    return found.groupBy("part").applyInArrow(
        classes, "of_chunk long, ids binary, c binary, class binary")


def sequences(chunks: DataFrame, values: DataFrame, model: Model) -> DataFrame:
    """(row, learn, n_tokens, n_known, base_score, counts: sum of the known words' log10 counts,
    codes binary) per document.  A token's code is its class; one of the class of its shape
    plus size for a word seen once there, and plus size + END for an unseen one."""
    shared = chunks.sparkSession.sparkContext.broadcast(model)
    size, kind = len(model.matrix), _bytes(len(model.matrix) + 2 * END)
    left = chunks.select("chunk", "place", "row", "learn", "tokens", "lengths")
    schema = T.StructType([left.schema["row"], left.schema["learn"],
                           *(T.StructField(n, T.LongType()) for n in ("n_tokens", "n_known")),
                           *(T.StructField(n, T.DoubleType()) for n in ("base_score", "counts")),
                           T.StructField("codes", T.BinaryType())])

    def unpacked(column, kind, packed=True):
        return np.concatenate([np.zeros(0, kind), *(
            unpack_numbers(x, kind) if packed else np.frombuffer(x, kind) for x in column.to_pylist())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model = shared.value
        whole = left.filter(pc.is_valid(left["tokens"]))
        docs = left.filter(pc.is_null(left["tokens"])).sort_by("place")
        lengths = np.asarray(whole["lengths"][0].as_py(), np.int64)
        ids = unpacked(right["ids"], "<i4")
        # the last number is the end, the one word of its class
        count, of = np.zeros(len(ids) + 1, np.int64), np.full(len(ids) + 1, END)
        count[ids], of[ids] = unpacked(right["c"], "<i8"), unpacked(right["class"], _bytes(size), False)
        count[-1] = model.ends
        code = of + np.where(of < END, np.select([count == 0, count == 1], [size + END, size], 0), 0)
        logs = np.log10(np.maximum(count, 1))
        logs[-1] = 0
        flat = _with_ends(unpack_numbers(whole["tokens"][0].as_py()), lengths)
        stops = np.cumsum(lengths + 1)
        starts, codes = stops - lengths - 1, code.astype(kind)[flat]
        out = docs.select(["row", "learn"])
        for name, value in (
                ("n_tokens", lengths + 1), ("n_known", (count > 0).astype(np.int64)),
                ("base_score", model.base(count.astype(np.float64))), ("counts", logs)):
            out = out.append_column(name, pa.array(
                value if name == "n_tokens" else np.add.reduceat(value[flat], starts)))
        return out.append_column("codes", pa.array(
            [codes[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary()))
    return left.groupBy("chunk").cogroup(values.groupBy("of_chunk")).applyInArrow(run, schema)


def _classes(size: int) -> np.ndarray:
    """The class of each code."""
    return np.concatenate([np.arange(size), np.arange(END), np.arange(END)])


def counted(codes: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(class bigrams, words seen once by class) of the ``sequences`` of learnt texts."""
    kind, of = _bytes(size + 2 * END), _classes(size)

    def run(batches):
        sums = np.zeros(size * size + END, np.int64)
        for b in batches:
            flat = np.frombuffer(b"".join(b["codes"].to_pylist()), kind).astype(np.int64)
            classes = of[flat]
            sums += np.bincount(np.append(END, classes[:-1])[:len(flat)] * size + classes,
                                minlength=len(sums))
            once = flat[(flat >= size) & (flat < size + END)] - size
            sums += np.bincount(once + size * size, minlength=len(sums))
        cells = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(sums[cells])], names=["cell", "n"])
    sums = np.zeros(size * size + END)
    for r in (codes.select("codes").mapInArrow(run, "cell long, n long").groupBy("cell")
              .agg(F.sum("n").alias("n")).collect()):                  # size * size + END at most
        sums[r["cell"]] = r["n"]
    return sums[:size * size].reshape(size, size), np.append(sums[size * size:], np.zeros(size - END))


def score(docs: DataFrame, learn: Column, text: str = "text", keep=("doc_id",),
          classes: int = CLASSES, share: int = SHARE, tolerance: float = TOLERANCE) -> DataFrame:
    """(row struct of the kept columns, learn boolean, n_tokens, n_known, train_tokens long,
    base_score, score double) for every row; the model is learnt from rows where ``learn``.

    n_known counts tokens that were learnt; scores are sums of log10 probabilities, so that
    10 ** (-score / n_tokens) is a text's perplexity."""
    chunks = stored(numbered(docs, keep, text, learn), "numbered-texts")
    whole = chunks.filter("tokens IS NOT NULL")
    ends = chunks.filter("learn").count()
    r = whole.agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y))
                  .alias("tokens"), F.sum(F.size("words")).alias("words")).first()
    tokens, groups = (r["tokens"] or 0) + ends, -(-(r["words"] or 1) // GROUP_WORDS)
    words = (whole.select(F.explode(F.arrays_zip("words", "counts")).alias("of"))
             .filter("of.counts > 0").groupBy(F.col("of.words").alias("word"))
             .agg(F.sum("of.counts").alias("c")))
    # SHARE rows at most: each has one of SHARE learnt tokens
    r = words.agg(F.count(F.lit(1)).alias("types"), F.collect_list(F.when(
        F.col("c") * F.lit(share) >= F.lit(tokens), F.struct("c", "word"))).alias("frequent")).first()
    types = r["types"] + (ends > 0)
    frequent = sorted(r["frequent"], key=lambda r: (-r["c"], r["word"]))
    number = {r["word"]: FIRST + i for i, r in enumerate(frequent)}
    pairs = stored(bigrams(docs, text, learn, number), "bigrams")
    own, matrix, _ = exchange(pairs, len(frequent), classes, tolerance)
    size, known = len(matrix), {r["word"]: int(c) for r, c in zip(frequent, own)}
    model = Model(matrix, np.zeros(size), tokens, types, ends)
    values = placed(contexts(whole, known, size, max(1, groups)), model, known)
    coded = stored(sequences(chunks, values, model), "class-sequences")
    model = Model(*counted(coded.filter("learn"), size), tokens, types, ends)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = _bytes(size + 2 * END)
    schema = T.StructType([*(f for f in coded.schema if f.name not in ("counts", "codes")),
                           T.StructField("score", T.DoubleType())])

    def run(batches):
        model, of = shared.value, _classes(size)
        # the known with a count of 1, whose logarithm is 0; the end is its class's only word
        each = model.emission(np.repeat([1, 0], [size + END, END]), of)
        each[END] = 0
        for b in batches:
            if not len(b):
                continue
            flat = np.frombuffer(b"".join(b["codes"].to_pylist()), kind).astype(np.int64)
            classes = of[flat]
            steps = each[flat] + model.follow[np.append(END, classes[:-1]), classes]
            starts = np.cumsum(b["n_tokens"].to_numpy()) - b["n_tokens"].to_numpy()
            total = np.add.reduceat(steps, starts) + b["counts"].to_numpy()
            yield pa.RecordBatch.from_arrays([*(b[n] for n in schema.names[:-1]), pa.array(total)],
                                             names=schema.names)
    return coded.mapInArrow(run, schema).select(
        "row", "learn", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score", "score")
