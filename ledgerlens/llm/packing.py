"""Sum-of-squares packing of tokenised documents into fixed-length sequences.

A document longer than the capacity is cut into full pieces, with a shorter
first piece if its length leaves a remainder.  Pieces are then placed one after
the other: for each, among all gaps that open sequences have left (and a fresh
sequence), take the one after which the sum of the squared counts of open
sequences per gap is smallest.  That keeps the gaps of all sizes equally
frequent, so that a later piece finds one that it fills exactly.

Only (id, piece, length) rows are shuffled, never ids.  They are dealt by hash
into groups of about ``GROUP_ROWS`` pieces; each group is packed by itself in one
task, so the number of tasks grows with the input and a task's memory doesn't.
What a group leaves open at its end (a few sequences in tens of thousands) is
not shared with other groups.

Defined results: a null text is an empty text, which has the end id alone; equal
rows are packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.bpe import _map_rows, encoded

CAPACITY = 2048
END_ID = 0
GROUP_ROWS = 65_536


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: full ones after a shorter first."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], length])]


def pieces(df: DataFrame, spec: str, capacity: int = CAPACITY, end_id: int = END_ID,
           text: str = "text", keep=("doc_id",), checksum: bool = False) -> DataFrame:
    """keep columns, piece int, start long, length long, ids binary per piece; with
    ``checksum``, ids_crc32 long in place of the ids, which then stay in the worker."""
    end = np.array([end_id], "<u4").tobytes()

    def work(v, column):
        for i, ids in encoded(v, column):
            ids += end
            for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                part = ids[4 * start:4 * (start + length)]
                yield i, (k, start, length, zlib.crc32(part) if checksum else part)
    last = (("ids_crc32", T.LongType(), pa.int64()) if checksum
            else ("ids", T.BinaryType(), pa.binary()))
    return _map_rows(df, keep, text, spec,
                     [("piece", T.IntegerType(), pa.int32()), ("start", T.LongType(), pa.int64()),
                      ("length", T.LongType(), pa.int64()), last],
                     work, (lambda r: 0) if checksum else (lambda r: len(r[-1])))


def sum_of_squares(lengths, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each length, placed longest first."""
    lengths = np.asarray(lengths, dtype=np.int64)
    open_count = np.zeros(capacity + 1, dtype=np.int64)     # sequences per gap left
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, used = np.empty_like(lengths), np.empty_like(lengths), 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        if s >= capacity:
            sequence[i], offset[i], used = used, 0, used + 1
            continue
        # change of the sum of squares when a gap g shrinks to g - s: from
        # open[g]^2 + open[g-s]^2 to (open[g]-1)^2 + (open[g-s]+1)^2; a closed
        # sequence (gap 0) and a fresh one (gap = capacity) do not count.
        gap = open_count[s:]
        change = np.where(gap > 0, 2 * (open_count[:capacity + 1 - s] - gap) + 2, 1 << 40)
        if gap[0] > 0:
            change[0] = 1 - 2 * gap[0]
        change[-1] = 2 * open_count[capacity - s] + 1
        g = s + int(change.argmin())
        if g == capacity:
            bin_, used = used, used + 1
        else:
            bin_ = waiting[g].pop()
            open_count[g] -= 1
        sequence[i], offset[i] = bin_, capacity - g
        if g > s:
            waiting[g - s].append(bin_)
            open_count[g - s] += 1
    return sequence, offset


def pack(parts: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
         order=("doc_id", "piece")) -> DataFrame:
    """The rows of ``parts`` with sequence_id long and offset long.

    ``parts`` needs a ``length`` from 1 to the capacity and is read twice (once to
    be counted): hand over a checkpoint or a table."""
    groups = max(1, -(-parts.count() // group_rows))
    dealt = parts.withColumn("__group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        group = int(pdf["__group"].iloc[0])
        pdf = pdf.sort_values(list(order), kind="stable", ignore_index=True)
        sequence, offset = sum_of_squares(pdf["length"], capacity)
        out = pdf.drop(columns="__group")
        out["sequence_id"], out["offset"] = sequence + (group << 32), offset
        return out
    return dealt.groupBy("__group").applyInPandas(run, schema)
