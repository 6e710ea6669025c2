"""Near-duplicate documents by b-bit MinHash.

Each document's set of word shingles gets ``HASHES`` minima.  Bands of ``ROWS`` whole
minima give the candidate buckets; of every minimum only its low ``BITS`` bits are
kept, packed into longs.  Two signatures are compared by counting equal lanes
(exclusive or, fold, bit count); as unequal minima agree in b bits by chance with
C = 2^-b, the similarity is (share - C) / (1 - C).  Candidates below a bound that a
pair at the similarity limit misses with a chance under ``MISS`` are dropped, all
others are confirmed on the full shingle sets.

No bucket is ever expanded into all its pairs:

* Documents with equal sets are one node from the start.
* Each bucket's members are paired with its first member only; each member's most
  similar pair is confirmed, and links are joined into components.
* A component and the nodes whose most similar pair led there without a link form a
  cluster.  These nodes visit their cluster: they are compared with all its members.
* In buckets that hold more than one cluster, members of different clusters are
  compared by signature -- small buckets by a join, large ones in blocks of ``BLOCK``
  members inside tasks.  Of all pairs that pass between a node and a cluster one
  row remains: the node of the smaller cluster visits the other one.
* Visits are confirmed on full sets in blocks of members and visitors inside tasks,
  which return only links that join components.

What is not compared then has no passing pair or is within a component already, so
the result is that of confirming all candidates.  With 32 bands of 4 rows a pair of
similarity 0.8 has no common bucket with a chance of 5e-8.

Defined results: a null or blank text has the empty set, is linked with nothing
and kept; a text with fewer words than a shingle has its whole word sequence as
its one shingle; equal rows are linked, so one row id stays, with all rows that
carry it; a null id takes no part: component null, kept.  Other columns are not
read.  An empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from ledgerlens.llm.graph import components
from ledgerlens.llm.scratch import stored

HASHES = 128
ROWS = 4
BITS = 2
PERCENT = 80
MISS = 1e-9
SMALL_BUCKET = 16
BLOCK = 512
TEXT_BLOCK = 256           # members and visitors compared in one task
MEMO_WORDS = 300_000
CHUNK = 2048               # shingles permuted at once
EVEN = 0x5555555555555555

_rng = np.random.default_rng(20240607)
_MULTIPLY = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


_WORDS = _WordHash()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if len(_WORDS) > MEMO_WORDS:
        _WORDS.clear()
    w = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(size, len(w))
    if k == 0:
        return w
    n = len(w) - k + 1
    mixed = np.full(n, k, np.uint64)
    for j in range(k):
        mixed = (mixed ^ w[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The smallest 32-bit value under each of the permutations."""
    low = np.full(HASHES, np.uint64(1 << 32))
    for lo in range(0, len(shingles), CHUNK):
        v = shingles[lo:lo + CHUNK] * _MULTIPLY[:, None]
        v += _ADD[:, None]
        v >>= np.uint64(32)
        np.minimum(low, v.min(axis=1), out=low)
    return low


def pack(low: np.ndarray) -> np.ndarray:
    """Low bits of the minima, ``64 / BITS`` to a long."""
    lanes = (low & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    shift = np.arange(0, 64, BITS, dtype=np.uint64)
    return np.bitwise_or.reduce(lanes << shift, axis=1).view(np.int64)


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, the band's number mixed in."""
    rows = low.reshape(-1, ROWS)
    key = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = (key ^ rows[:, j]) * np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(32)
    return key.view(np.int64)


def most_unequal(percent: int = PERCENT) -> int:
    """Unequal lanes that a pair at the limit exceeds with a chance under MISS."""
    p, tail = (1 - percent / 100) * (1 - 0.5 ** BITS), 0.0
    for k in range(HASHES, -1, -1):
        tail += math.comb(HASHES, k) * p ** k * (1 - p) ** (HASHES - k)
        if tail > MISS:
            return k
    return HASHES


def similarity(unequal):
    """Estimated Jaccard similarity, corrected for chance agreement."""
    c = 0.5 ** BITS
    return ((1 - unequal / HASHES) - c) / (1 - c)


LONGS = HASHES * BITS // 64


def signatures(df: DataFrame, size: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, whole, node binary, n long, sig array<long>, bands array<long>) per row; node is a
    128-bit hash of the set, null for the empty one."""
    source = df.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("whole"),
                       F.col(text).alias("value"))
    schema = T.StructType([source.schema["doc"], T.StructField("whole", T.LongType(), False),
                           T.StructField("node", T.BinaryType()),
                           T.StructField("n", T.LongType()),
                           T.StructField("sig", T.ArrayType(T.LongType())),
                           T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                nodes, ns, sigs, bands = [], [], [], []
                for value in part[2]:
                    s = shingle_set(value.as_py(), size)
                    low = minima(s) if len(s) else None
                    nodes.append(xxh3_128_digest(s.tobytes()) if len(s) else None)
                    ns.append(len(s))
                    sigs.append(None if low is None else pack(low))
                    bands.append(None if low is None else band_keys(low))
                yield pa.RecordBatch.from_arrays(
                    [part[0], part[1], pa.array(nodes, pa.binary()), pa.array(ns, pa.int64()),
                     pa.array(sigs, pa.list_(pa.int64())), pa.array(bands, pa.list_(pa.int64()))],
                    names=schema.names)
    return source.mapInArrow(_forgetful(run), schema)


def _forgetful(run):
    """The function of a task, after which a reused worker keeps no words."""
    def forgets(batches):
        try:
            yield from run(batches)
        finally:
            _WORDS.clear()
            pa.default_memory_pool().release_unused()
    return forgets


def _unequal(a: str, b: str):
    """Number of unequal lanes of two packed signatures."""
    total = F.lit(0)
    for k in range(LONGS):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        for shift in range(1, BITS):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        total = total + F.bit_count(x.bitwiseAND(F.lit(EVEN)))
    return total


def _passing(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, unequal) of the pairs that pass the size and the signature test."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"),
                                  F.col("sig").alias(f"sig_{c}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            .select("a", "b", _unequal("sig_a", "sig_b").alias("unequal"))
            .filter(F.col("unequal") <= most_unequal(percent)))


def _confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, linked) from the full shingle sets."""
    rows = (pairs.select("a", "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b"))

    def run(batches):
        sets: dict[bytes, np.ndarray] = {}

        def of(node, text):
            if node not in sets:
                if len(sets) >= 64:
                    sets.clear()
                sets[node] = shingle_set(text.as_py(), size)
            return sets[node]
        for batch in batches:
            linked = []
            for a, b, ta, tb in zip(batch[0].to_pylist(), batch[1].to_pylist(),
                                    batch[2], batch[3]):
                x, y = of(a, ta), of(b, tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch[0], batch[1], pa.array(linked, pa.bool_())], names=["a", "b", "linked"])
    return rows.select("a", "b", "ta", "tb").mapInArrow(
        _forgetful(run), "a binary, b binary, linked boolean")


def _block_visits(members: DataFrame, percent: int) -> DataFrame:
    """(cluster, node) visits from large buckets: each bucket is cut into blocks, each
    pair of blocks compared inside a task."""
    blocks = F.ceil(F.col("members") / F.lit(BLOCK)).cast("long")
    dealt = (members.withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"),
                                                       F.col("blocks") - 1)))
             .withColumn("lo", F.least("block", "other"))
             .withColumn("hi", F.greatest("block", "other")))
    limit = most_unequal(percent)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sig = np.array(pdf["sig"].tolist(), np.int64).view(np.uint64)
        node, n = pdf["node"].to_numpy(), pdf["n"].to_numpy()
        cluster, size = pdf["cluster"].to_numpy(), pdf["size"].to_numpy()
        number = pd.factorize(pdf["cluster"])[0]
        block = pdf["block"].to_numpy()
        first = np.flatnonzero(block == pdf["lo"].iloc[0])
        second = np.flatnonzero(block == pdf["hi"].iloc[0])
        out = set()
        for i in first:
            x = sig[second] ^ sig[i]
            for shift in range(1, BITS):
                x |= x >> np.uint64(shift)
            unequal = np.bitwise_count(x & np.uint64(EVEN)).sum(axis=1)
            fit = ((unequal <= limit) & (number[second] != number[i])
                   & (100 * np.minimum(n[second], n[i]) >= percent * np.maximum(n[second], n[i])))
            for j in second[fit]:
                here, there = ((i, j) if (size[i], cluster[i]) < (size[j], cluster[j]) else (j, i))
                out.add((cluster[there], node[here]))
        return pd.DataFrame(list(out), columns=["cluster", "node"])
    return (dealt.select("key", "lo", "hi", "block", "node", "n", "sig", "cluster", "size")
            .groupBy("key", "lo", "hi").applyInPandas(run, "cluster binary, node binary"))


def _visits(buckets: DataFrame, clusters: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(cluster, node): visitors from buckets with more than one cluster."""
    at = buckets.join(clusters.select("node", "cluster", "size"), "node")
    mixed = (at.groupBy("key").agg(F.min("cluster").alias("l"), F.max("cluster").alias("h"),
                                   F.count(F.lit(1)).alias("members"))
             .filter("l <> h").select("key", "members"))
    members = stored(at.join(mixed, "key").join(nodes.select("node", "n", "sig"), "node"),
                     "mixed-buckets")
    side = lambda c: members.filter(F.col("members") <= SMALL_BUCKET).select(
        "key", *[F.col(x).alias(f"{x}_{c}") for x in ("node", "n", "sig", "cluster", "size")])
    pairs = (side("a").join(side("b"), "key")
             .filter((F.col("cluster_a") != F.col("cluster_b"))
                     & ((F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b"))
                        & (F.col("cluster_a") < F.col("cluster_b")))))
             .filter((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
                     & (_unequal("sig_a", "sig_b") <= most_unequal(percent)))
             .select(F.col("cluster_b").alias("cluster"), F.col("node_a").alias("node")))
    large = _block_visits(members.filter(F.col("members") > SMALL_BUCKET), percent)
    return pairs.union(large).distinct()


def _links_of(members: list, visitors: list, size: int, percent: int) -> list[tuple]:
    """Links (visitor, member) that join components; entries are (node, label, text)."""
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    m, v = ([shingle_set(t, size) for *_, t in side] for side in (members, visitors))
    # numbers of the shingles that two of them share at least; others do not count
    _, at, often = np.unique(np.concatenate([*m, *v]), return_inverse=True, return_counts=True)
    shared = np.cumsum(often > 1) - 1
    keep, row = often[at] > 1, np.repeat(np.arange(len(m) + len(v)), [len(x) for x in (*m, *v)])
    row, column = row[keep], shared[at[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((len(v), len(m)))
    for lo in range(0, int(shared[-1]) + 1, CHUNK):
        i, j = np.searchsorted(column, (lo, lo + CHUNK))
        grid = np.zeros((len(m) + len(v), CHUNK), np.float32)
        grid[row[i:j], column[i:j] - lo] = 1
        both += grid[len(m):] @ grid[:len(m)].T
    sizes_m, sizes_v = (np.array([len(x) for x in side]) for side in (m, v))
    out = []
    for i, j in zip(*np.nonzero(100 * both >= percent * (sizes_v[:, None] + sizes_m[None, :]
                                                        - both))):
        (a, la, _), (b, lb, _) = visitors[i], members[j]
        if root(la) != root(lb):
            parent[root(la)] = root(lb)
            out.append((a, b))
    return out


def _confirm_visits(visits: DataFrame, clusters: DataFrame, texts: DataFrame, size: int,
                    percent: int) -> DataFrame:
    """(a, b) links between visitors and members, from the full sets."""
    count = visits.groupBy("cluster").agg(F.count(F.lit(1)).alias("visitors"))
    counted = (clusters.join(count, "cluster")
               .withColumn("m_blocks", F.ceil(F.col("size") / F.lit(TEXT_BLOCK)).cast("long"))
               .withColumn("v_blocks", F.ceil(F.col("visitors") / F.lit(TEXT_BLOCK)).cast("long")))
    blocks = counted.select("cluster", "m_blocks", "v_blocks").distinct()
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    members = (counted.withColumn("mi", own("m_blocks")).withColumn("vi", each("v_blocks"))
               .select("cluster", "mi", "vi", F.lit(True).alias("member"), "node", "label"))
    visitors = (visits.join(blocks, "cluster")
                .join(clusters.select("node", "label"), "node")
                .withColumn("vi", own("v_blocks")).withColumn("mi", each("m_blocks"))
                .select("cluster", "mi", "vi", F.lit(False).alias("member"), "node", "label"))
    rows = members.union(visitors).join(texts, "node")
    key = ["cluster", "mi", "vi"]

    def run(batches):
        now, sides = None, ([], [])

        def links():
            got = _links_of(*sides, size, percent) if sides[0] and sides[1] else ()
            if got:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.binary()) for c in zip(*got)], names=["a", "b"])
        for b in batches:
            for cluster, mi, vi, member, node, label, text in zip(
                    *(b.column(c).to_pylist() for c in b.schema.names)):
                if (cluster, mi, vi) != now:
                    yield from links()
                    now, sides = (cluster, mi, vi), ([], [])
                sides[0 if member else 1].append((node, label, text))
        yield from links()
    return (rows.select(*key, "member", "node", "label", "text")
            .repartition(*key).sortWithinPartitions(*key).mapInArrow(_forgetful(run), "a binary, b binary"))


def find(df: DataFrame, size: int = 5, percent: int = PERCENT, doc_id: str = "doc_id",
         text: str = "text") -> DataFrame:
    """(doc_id, whole long, n_shingles long, component_id, kept boolean) per row; whole is
    xxhash64 of the text, to tell rows with one id apart."""
    rows = stored(signatures(df, size, doc_id, text), "signatures")
    nodes = stored(rows.filter("node IS NOT NULL AND doc IS NOT NULL")
                   .groupBy("node").agg(F.min(F.struct("doc", "whole")).alias("place"),
                                        F.first("n").alias("n"), F.first("sig").alias("sig"),
                                        F.first("bands").alias("bands"))
                   .select("node", "place.*", "n", "sig", "bands"), "nodes")
    # buckets with more than one member, and the first member of each
    dealt = nodes.select("node", F.explode("bands").alias("key"))
    first = stored(dealt.groupBy("key").agg(F.min("node").alias("first"),
                                            F.count(F.lit(1)).alias("size"))
                   .filter("size > 1").select("key", "first"), "buckets")
    buckets = stored(dealt.join(first, "key"), "bucket-members")
    star = (buckets.filter("node <> first")
            .select(F.col("first").alias("a"), F.col("node").alias("b")).distinct())
    star = stored(_passing(star, nodes, percent), "candidates")
    best = (star.groupBy("b").agg(F.min(F.struct("unequal", "a")).alias("x"))
            .select(F.col("x.a").alias("a"), "b"))
    # all that any later step can ask for, in one pass over the texts
    texts = _texts(df, nodes, buckets.select("node").distinct(), doc_id, text)
    links = stored(_confirmed(best, texts, size, percent).filter("linked").select("a", "b"),
                   "links")
    labels = components(links)
    # clusters: a component, and the nodes whose best pair led there without a link
    home = (best.select(F.col("b").alias("node"), "a")
            .join(labels.select(F.col("node").alias("a"), F.col("label").alias("of_a")), "a", "left")
            .select("node", F.coalesce("of_a", "a").alias("home")))
    clusters = stored(buckets.select("node").distinct().join(labels, "node", "left")
                      .join(home, "node", "left")
                      .select("node", F.coalesce("label", "node").alias("label"),
                              F.coalesce("label", "home", "node").alias("cluster"),
                              F.col("label").isNull().alias("single")), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    clusters = stored(clusters.join(sizes, "cluster"), "sized-clusters")
    visits = stored(clusters.filter("single AND size > 1").select("cluster", "node")
                    .union(_visits(buckets.select("node", "key"), clusters, nodes, percent))
                    .distinct(), "visits")
    more = stored(_confirm_visits(visits, clusters, texts, size, percent), "links")
    labels = components(links.union(more))
    named = nodes.select("node", "doc").join(labels, "node", "left").withColumn(
        "label", F.coalesce("label", "node"))
    heads = named.groupBy("label").agg(F.min("doc").alias("component_id"))
    # of the joins below, both sides are one row per node or component
    of_node = named.join(heads, "label").select("node", "component_id")
    own = F.coalesce("component_id", "doc")
    return (rows.select("doc", "whole", "node", "n").join(of_node, "node", "left")
            .select(F.col("doc").alias("doc_id"), "whole", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc").isNotNull(), own).alias("component_id"),
                    (F.col("doc").isNull() | (own == F.col("doc"))).alias("kept")))


def survivors(df: DataFrame, size: int = 5, percent: int = PERCENT, doc_id: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, one for each group of near-duplicates."""
    kept = (find(df, size, percent, doc_id, text).filter("kept")
            .select(F.col("doc_id").alias("__doc"), F.col("whole").alias("__whole")))
    rows = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("__row"),
                     F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__text"))
    return (rows.join(kept, F.col("__id").eqNullSafe(F.col("__doc"))
                      & (F.col("__text") == F.col("__whole")), "left_semi")
            .dropDuplicates(["__id", "__text"]).select("__row.*"))


def _texts(df: DataFrame, nodes: DataFrame, wanted: DataFrame, doc_id: str, text: str
           ) -> DataFrame:
    """(node, text) of the wanted nodes: one text of each."""
    places = nodes.select("node", "doc", "whole").join(wanted, "node")
    found = (df.select(F.col(doc_id).alias("doc"), F.xxhash64(text).alias("whole"),
                       F.col(text).alias("text")).join(places, ["doc", "whole"]))
    # rows equal in id and text repeat: one of them
    return stored(found.groupBy("node").agg(F.first("text").alias("text")), "texts")
