"""Byte-pair encoding and decoding by forced-boundary splitting.

A merge can only join two neighbouring bytes if some vocabulary token holds
that byte pair.  Wherever a text has a pair that no token holds, every encoding
must cut there: the fragments between such cuts are encoded independently (by
lowest-rank merging) and their ids are concatenated.  White space in front of a
word is the most frequent certain cut, so whole words are looked up in a bounded
per-worker memo before anything is merged.

The work is row-parallel: one pass over the table, no shuffle.  The vocabulary
file is read once on the driver and broadcast (its size, a few MB, is fixed by
the tokenizer and does not grow with the data).

Defined results: a null text is an empty text (no ids, empty decoded text); rows
repeat if they repeat in the input; columns not named by the caller are not read,
so clashing names do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import gc
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The split pattern of byte-level BPE vocabularies, and the
# characters that Python counts as white space but Unicode does not.
BYTE_LEVEL_PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                      r"|\s+(?!\S)|\s+")
NOT_SPACE = r"\x1c-\x1f"

# Fixed values where the Unicode versions differ: letters and numbers that the regex module knows
# and the pattern engine of the vocabularies' own library does not, and capitals that this
# library knows and Python does not.
LATER_LETTERS = (
    "\u0558 \u058b-\u058c \u088f \u0c5c \u0cdc \u208f \u209d-\u209f \ua7ce-\ua7cf \ua7dd \ua7e2 "
    "\ua7f1 \uab6c-\uab6d \U000107bb-\U000107bf \U00010940-\U00010959 \U00010ec5-\U00010ec7 "
    "\U00010ed9-\U00010eee \U00011b0a \U00011db0-\U00011ddb \U00011df1 \U00016ea0-\U00016eb8 "
    "\U00016ebb-\U00016ed3 \U00016ff2-\U00016ff3 \U000187f8-\U000187ff \U00018cd6-\U00018cda "
    "\U00018d09-\U00018d20 \U00018d80-\U00018df2 \U00018e00-\U00019191 \U000191a0-\U000191d2 "
    "\U0001b123-\U0001b128 \U0001b168 \U0001d6a6 \U0001df1f-\U0001df24 \U0001df2b-\U0001df81 "
    "\U0001df90-\U0001df96 \U0001dfcd-\U0001dfff \U0001e6c0-\U0001e6de \U0001e6e0-\U0001e6e2 "
    "\U0001e6e4-\U0001e6e5 \U0001e6e7-\U0001e6ed \U0001e6f0-\U0001e6f4 \U0001e6fe-\U0001e6ff "
    "\U0002b73a-\U0002b73f \U0002b81e \U0002cea2-\U0002cead \U000323b0-\U00033479 "
    "\U0003d000-\U0003fc3f").replace(" ", "")
LATER_NUMBERS = ("\U00011de0-\U00011de9 \U0001246f \U00012475-\U0001247f \U00012550-\U00012686 "
                 "\U00016ff4-\U00016ff6").replace(" ", "")
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
             0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
             **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
             **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}

ID_BITS = 24               # a merge is kept as rank << ID_BITS | new id
ID_MASK = (1 << ID_BITS) - 1
NEVER = (1 << 63) - 1      # value of a pair that does not merge
SLOTS = 20                 # bits of the pair table's size
MEMO_WORDS = 300_000      # words remembered by a task, twice (new and old half)
MEMO_WORD_CHARS = 64      # longer words are encoded each time
WIDTHS = (2, 4, 8, 12, 16, 24)   # fragments up to these lengths are merged side by side
GROUP_CHARS = 1 << 21     # text characters whose new words are encoded together
BATCH_BYTES = 8 << 20     # ids gathered before a batch goes back to Spark


def read_spec(path: str) -> str:
    """Text of a tokenizers JSON file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte in a vocabulary file:
    itself if visible, else the next free character from U+0100 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


def _unicode_space(pattern: str) -> str:
    """The pattern with \\s and \\S meaning Unicode white space exactly."""
    inside = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
    out, depth, i = [], 0, 0
    while i < len(pattern):
        two = pattern[i:i + 2]
        if two in (r"\s", r"\S") and depth == 0:
            out.append(f"[{'^' if two[1] == 'S' else ''}{inside}]")
            i += 2
        elif two == r"\s":
            out.append(inside)
            i += 2
        elif pattern[i] == "\\":
            out.append(two)
            i += 2
        else:
            depth += {"[": 1, "]": -1}.get(pattern[i], 0)
            out.append(pattern[i])
            i += 1
    return "".join(out)


_LATER = re.compile(f"[{LATER_LETTERS}{LATER_NUMBERS}]").search
_later_to_symbols = re.compile(f"[{LATER_LETTERS}{LATER_NUMBERS}]").sub
_NEW_CAPITALS = frozenset(map(chr, NEW_LOWER))
_WORD = re.compile(rf"[\S{NOT_SPACE}]+").findall
_SPACES_AND_WORD = re.compile(
    rf"[^\S{NOT_SPACE}]*[\S{NOT_SPACE}]+|[^\S{NOT_SPACE}]+").findall
# Fixed values, in UTF-8: white space other than a blank and a line break (some are beginnings
# that other characters share), and two of those side by side.
_OTHER_SPACE = (b"\t", b"\x0b", b"\x0c", b"\r", b"\x00", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80",
                b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80", b"  ", b" \n", b"\n ", b"\n\n")


def _split_words(text: str) -> list[str]:
    """The stretches between white space."""
    # str.split takes four control characters for white space
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return _WORD(text)
    return text.split()


def _split_before_spaces(text: str) -> list[str]:
    """The text cut in front of each stretch of white space."""
    raw = text.encode("utf-8")
    if any(s in raw for s in _OTHER_SPACE):
        return _SPACES_AND_WORD(text)
    # each white space is a single blank or line break
    parts = text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
    return parts if parts[0] else parts[1:]


class _Pairs:
    """Merge values of many symbol pairs at once: a hash table in arrays."""

    def __init__(self, merge: dict[tuple[int, int], int]):
        size = 1 << SLOTS
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, NEVER, np.int64)
        self.probes = 1
        for (a, b), value in merge.items():
            key = a << ID_BITS | b
            slot = key * 0x9E3779B97F4A7C15 % (1 << 64) >> (64 - SLOTS)
            step = 0
            while self.keys[(slot + step) % size] >= 0:
                step += 1
            self.probes = max(self.probes, step + 1)
            self.keys[(slot + step) % size], self.values[(slot + step) % size] = key, value

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << ID_BITS | b
        slot = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                >> np.uint64(64 - SLOTS)).view(np.int64)
        out = np.where(self.keys[slot] == key, self.values[slot], NEVER)
        for step in range(1, self.probes):
            at = (slot + step) & ((1 << SLOTS) - 1)
            hit = self.keys[at] == key
            out[hit] = self.values[at[hit]]
        return out


class Vocabulary:
    """A byte-level BPE vocabulary in the tokenizers JSON format."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model = j["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") \
                or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        chars = _byte_chars()
        # symbol of a byte inside a word, and of a word's last byte
        self.first = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + suffix] for c in chars], np.int64)
        self.merge = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge[vocab[a], vocab[b]] = rank << ID_BITS | vocab[a + b]
        byte_of = {c: b for b, c in enumerate(chars)}
        self.pairs = _Pairs(self.merge)
        self.inside = np.zeros(1 << 16, bool)               # byte pairs that some token holds
        for token in vocab:
            for a, b in zip(token, token[1:]):
                self.inside[byte_of[a] << 8 | byte_of[b]] = True
        added = {t["content"]: t["id"] for t in j.get("added_tokens") or ()}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
               for t in j.get("added_tokens") or ()):
            raise ValueError("added tokens with options are not supported")
        self.added = {k: np.array([v], "<u4").tobytes() for k, v in added.items()}
        self.cut_added = re.compile("(" + "|".join(
            map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self._read_normalizer(j.get("normalizer"))
        self._read_splitter(j["pre_tokenizer"])
        self._read_decoder(j.get("decoder"), byte_of)
        self.token = [""] * (1 + max([*vocab.values(), *added.values()]))
        for k, v in (vocab | added).items():
            self.token[v] = k
        self.memo, self.old = {}, {}

    def _read_normalizer(self, n):
        parts = [] if n is None else n["normalizers"] if n["type"] == "Sequence" else [n]
        kinds = [p["type"] for p in parts]
        if kinds not in ([], ["NFC", "Replace", "Lowercase"]):
            raise ValueError(f"normalizer {kinds} is not supported")
        self.normalize = bool(kinds)

    def _read_splitter(self, p):
        parts = p["pretokenizers"] if p["type"] == "Sequence" else [p]
        if parts[-1]["type"] != "ByteLevel" or parts[-1]["add_prefix_space"]:
            raise ValueError("only byte-level vocabularies without a prefix space")
        if len(parts) == 2 and parts[0]["type"] == "Split" and parts[0]["invert"] \
                and parts[0]["behavior"] == "Removed" and not parts[1]["use_regex"]:
            pattern = parts[0]["pattern"]["Regex"]          # keeps the matches, drops the rest
            self.chunks = _split_words
        elif len(parts) == 1 and parts[0]["use_regex"]:
            pattern = BYTE_LEVEL_PATTERN
            self.chunks = _split_before_spaces
        else:
            raise ValueError("this pre-tokenizer is not supported")
        self.find_pieces = regex.compile(_unicode_space(pattern)).findall

    def _read_decoder(self, d, byte_of):
        if d is not None and d["type"] != "ByteLevel":
            raise ValueError(f"decoder {d['type']} is not supported")
        self.byte_of = {ord(c): b for c, b in byte_of.items()} if d else None

    # ---- encoding ----

    def pieces(self, chunk: str) -> list[str]:
        """The pre-tokenizer's pieces of a chunk."""
        if chunk.isascii() or not _LATER(chunk):
            return self.find_pieces(chunk)
        # characters that the library does not know are cut as a symbol would be
        out, at = [], 0
        for p in self.find_pieces(_later_to_symbols("\ue000", chunk)):
            out.append(chunk[at:at + len(p)])
            at += len(p)
        return out

    def forget(self) -> None:
        """Drop the remembered words, so that a reused worker does not keep them."""
        self.memo, self.old = {}, {}

    def _encode_new(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk.  All bytes stand in one array; pieces end, and forced
        boundaries cut, the fragments, which are then merged side by side."""
        every, per_chunk = [], []
        for c in chunks:
            # a word of letters, with the space that byte-level patterns keep, is one piece
            if c.isalpha() or c[0] == " " and c[1:].isalpha():
                every.append(c)
                per_chunk.append(1)
            else:
                pieces = self.pieces(c)
                every += pieces
                per_chunk.append(len(pieces))
        raw = list(map(str.encode, every))
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        if not len(flat):
            return [b""] * len(chunks)
        ends = np.cumsum(sizes) - 1
        symbols = self.first[flat]
        symbols[ends] = self.last[flat[ends]]
        cut = np.ones(len(flat), bool)
        wide = flat.astype(np.int64)
        cut[1:] = ~self.inside[wide[:-1] << 8 | wide[1:]]
        cut[ends[:-1] + 1] = True
        start = np.flatnonzero(cut)
        length = np.diff(np.append(start, len(flat)))
        merged = self._merge_all(symbols, start, length)
        left = np.zeros(len(flat) + 1, np.int64)
        left[1:] = np.cumsum(merged >= 0)
        out = merged[merged >= 0].astype("<u4").tobytes()
        stops = np.cumsum(per_chunk)
        edges = np.concatenate([[0], ends + 1])[np.concatenate([[0], stops])]
        at = (4 * left[edges]).tolist()
        return [out[i:j] for i, j in zip(at, at[1:])]

    def _merge_all(self, symbols, start, length) -> np.ndarray:
        """The symbols after merging, each fragment's at its front, -1 for the rest."""
        out = symbols.copy()
        low = 1
        for width in WIDTHS:
            rows = np.flatnonzero((length > low) & (length <= width))
            low = width
            if len(rows):
                place = start[rows][:, None] + np.arange(width)
                real = np.arange(width) < length[rows][:, None]
                s = np.where(real, symbols[np.minimum(place, len(symbols) - 1)], -1)
                s = self._merge_rows(s)
                out[place[real]] = s[real]
        for row in np.flatnonzero(length > low):
            i, n = int(start[row]), int(length[row])
            ids = self._merge_long(symbols[i:i + n].tolist())
            out[i:i + n] = -1
            out[i:i + len(ids)] = ids
        return out

    def _merge_rows(self, s: np.ndarray) -> np.ndarray:
        """Join the pair of lowest rank in each row, leftmost first, until none is left."""
        n, width = s.shape
        done = np.full_like(s, -1)
        who = np.arange(n)
        value = self.pairs.of(s[:, :-1], s[:, 1:])
        value[s[:, 1:] < 0] = NEVER
        while len(who):
            at = value.argmin(axis=1)
            row = np.arange(len(who))
            best = value[row, at]
            go = best < NEVER
            if not go.all():
                done[who[~go]] = s[~go]
                s, value, who, at, best = s[go], value[go], who[go], at[go], best[go]
                row = np.arange(len(who))
            if not len(who):
                break
            s[row, at] = best & ID_MASK
            # close the gap behind the merged symbol
            behind = np.arange(width - 1) > at[:, None]
            s[:, :-1] = np.where(behind, s[:, 1:], s[:, :-1])
            s[:, -1] = -1
            behind = np.arange(width - 2) >= at[:, None]
            value[:, :-1] = np.where(behind, value[:, 1:], value[:, :-1])
            value[:, -1] = NEVER
            has = np.flatnonzero(at > 0)
            value[has, at[has] - 1] = self.pairs.of(s[has, at[has] - 1], s[has, at[has]])
            after = s[row, np.minimum(at + 1, width - 1)]
            has = np.flatnonzero((at + 1 < width) & (after >= 0))
            value[has, at[has]] = self.pairs.of(s[has, at[has]], after[has])
            none = np.flatnonzero((at < width - 1) & ~((at + 1 < width) & (after >= 0)))
            value[none, at[none]] = NEVER
        return done

    def _merge_long(self, ids: list[int]) -> list[int]:
        get, n = self.merge.get, len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(m, i, p) for i, p in enumerate(zip(ids, ids[1:]))
                if (m := get(p)) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            m, i, pair = heapq.heappop(heap)
            j = after[i] if alive[i] else -1
            if j < 0 or (ids[i], ids[j]) != pair:
                continue                                    # one of the two has changed
            ids[i], alive[j], after[i] = m & ID_MASK, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (m := get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (m, a, (ids[a], ids[b])))
        return [x for x, keep in zip(ids, alive) if keep]

    def _chunks(self, text: str | None) -> list[str]:
        if not text:
            return []
        if self.cut_added and len(parts := self.cut_added.split(text)) > 1:
            # every second part is an added token, which stands for itself
            return [c for i, p in enumerate(parts)
                    for c in ((p,) if i % 2 else self._plain_chunks(p))]
        return self._plain_chunks(text)

    def _plain_chunks(self, text: str) -> list[str]:
        if self.normalize:
            if not text.isascii():
                # final sigma is not treated apart by the vocabulary's lower-casing
                text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
                if not _NEW_CAPITALS.isdisjoint(text):
                    text = text.translate(NEW_LOWER)
            text = text.lower()
        return self.chunks(text)

    def encode_group(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.memo) > MEMO_WORDS:        # the new half becomes the old one
            self.old, self.memo = self.memo, {}
        memo, old = self.memo, self.old
        cut = [self._chunks(t) for t in texts]
        unseen = set().union(*cut).difference(memo)
        for known in (old, self.added):
            again = list(unseen.intersection(known))
            memo.update(zip(again, map(known.__getitem__, again)))
            unseen.difference_update(again)
        fresh = list(unseen)
        memo.update(zip(fresh, self._encode_new(fresh)))
        out = [b"".join(map(memo.__getitem__, c)) for c in cut]
        for c in fresh:
            if len(c) > MEMO_WORD_CHARS:
                del memo[c]
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_group([text])[0]

    # ---- decoding ----

    def decode(self, ids: bytes | None) -> str:
        """Text of packed ids, special tokens included; unknown ids are left out."""
        numbers, n = np.frombuffer(ids or b"", "<u4"), len(self.token)
        if len(numbers) and int(numbers.max()) >= n:
            numbers = numbers[numbers < n]
        tokens = map(self.token.__getitem__, numbers.tolist())
        if self.byte_of is None:
            return " ".join(tokens)
        return "".join(tokens).translate(self.byte_of).encode("latin-1").decode("utf-8", "replace")


_VOCABULARIES: dict[int, Vocabulary] = {}


def vocabulary(spec: str) -> Vocabulary:
    """The parsed vocabulary, kept by the worker for its later tasks."""
    key = hash(spec)
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = Vocabulary(spec)
    return _VOCABULARIES[key]


def in_batches(rows: Iterable[tuple], names: Sequence[str], types: Sequence[pa.DataType],
               weigh) -> Iterable[pa.RecordBatch]:
    """Record batches of bounded size from rows; ``weigh(row)`` is a row's bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 64 + weigh(row)
        if size >= BATCH_BYTES:
            yield _batch(held, names, types)
            held, size = [], 0
    if held:
        yield _batch(held, names, types)


def _batch(rows, names, types):
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=list(names))


def _schema(df: DataFrame, keep: Sequence[str], *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([df.schema[c] for c in keep]
                        + [T.StructField(n, t) for n, t in fields])


def _map_rows(df: DataFrame, keep: Sequence[str], column: str, spec: str,
              fields: Sequence[tuple[str, T.DataType, pa.DataType]], work, weigh) -> DataFrame:
    """keep + fields, where ``work(vocabulary, column)`` yields (row number, field tuple)."""
    shared = df.sparkSession.sparkContext.broadcast(spec)
    names = [*keep, *(f[0] for f in fields)]
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = [*(to_arrow_type(df.schema[c].dataType) for c in keep), *(f[2] for f in fields)]

    def run(batches):
        v = vocabulary(shared.value)

        def rows():
            for b in batches:
                kept = [c.to_pylist() for c in b.columns[:-1]]
                for i, out in work(v, b.columns[-1]):
                    yield (*(c[i] for c in kept), *out)
        # nothing here refers to itself, and the collector would walk the memo over and over
        gc.disable()
        try:
            yield from in_batches(rows(), names, kinds, weigh)
        finally:
            gc.enable()
            v.forget()

    source = df.select(*keep, F.col(column).alias("__value"))
    return source.mapInArrow(run, _schema(df, keep, *((f[0], f[1]) for f in fields)))


def encoded(v: Vocabulary, column: pa.Array) -> Iterable[tuple[int, bytes]]:
    """(row number, ids) of a text column, in groups of about GROUP_CHARS characters."""
    held, size, first = [], 0, 0
    for value in column:
        held.append(value.as_py())
        size += len(held[-1] or "")
        if size >= GROUP_CHARS:
            yield from enumerate(v.encode_group(held), first)
            first, held, size = first + len(held), [], 0
    yield from enumerate(v.encode_group(held), first)


def encode(df: DataFrame, spec: str, text: str = "text", keep: Sequence[str] = ("doc_id",)
           ) -> DataFrame:
    """keep columns, n_tokens long, ids binary (little-endian unsigned 32-bit)."""
    def work(v, column):
        for i, ids in encoded(v, column):
            yield i, (len(ids) // 4, ids)
    return _map_rows(df, keep, text, spec,
                     [("n_tokens", T.LongType(), pa.int64()), ("ids", T.BinaryType(), pa.binary())],
                     work, lambda r: len(r[-1]))


def decode(df: DataFrame, spec: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",)
           ) -> DataFrame:
    """keep columns and decoded string, from packed ids."""
    def work(v, column):
        for i, value in enumerate(column):
            yield i, (v.decode(value.as_py()),)
    return _map_rows(df, keep, ids, spec, [("decoded", T.StringType(), pa.string())],
                     work, lambda r: len(r[-1]))
