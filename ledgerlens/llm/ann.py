"""Approximate nearest neighbours (Euclidean) by NN-descent and greedy graph search.

Building the graph: every distinct vector is a node.  A first graph comes from a few
random-hyperplane partitions, inside whose cells neighbours are found by brute
force; cells above twice ``LEAF`` nodes are split by hash.  Then NN-descent: each node
gathers its neighbours and reverse neighbours (one Spark join and one grouping),
these are compared with one another as neighbours of neighbours, and improvements
are merged into the graph's ``DEGREE`` nearest.  Only pairs of which one came in the round
before are compared, and only nodes with such a neighbour gather any.  Rounds go on until
a round changes less than ``CHANGED`` of all edges; each lowers distances, so they end.

Searching: each query keeps the ``BEAM`` nearest nodes it has seen.  In every round a
join expands the nodes of the beam that are not yet expanded into their graph
neighbours; it ends when the whole beam is expanded, as no node is expanded twice.  Queries
that are nodes start at themselves.  The nearest ``RESCORE`` of each beam are measured again on the
original vectors in double precision.

Comparisons use vectors in 16 bits per component with a scale of their own; those are
what the joins carry.  Hyperplane thresholds are medians of at most
``SAMPLE`` vectors (those of smallest hash); every vector is indexed.  Lists per
node are bounded by DEGREE, groups by LEAF and DEGREE; equal vectors are one node with
its smallest ids, so a vector that a third of all rows share is one node.

Defined results: vectors that are null, zero, or hold null or non-finite components
take no part, neither do null ids or vectors of another length than the most frequent
one; of rows that share an id the smallest vector counts; equal vectors all are
candidates, ties go to smaller ids; other columns are not read; fewer candidates than
asked for are all returned, and an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.scratch import stored

DEGREE = 24
TREES = 8
LEAF = 1024
CELL_NEIGHBOURS = 16       # kept per node and partition for the first graph
CHANGED = 0.02             # share of the edges that a last round changes
BEAM = 256
RESCORE = 64
SAMPLE = 4096
CODE_MAX = 32767


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part, one for each id."""
    v = F.col("vector")
    rows = (df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull())
            .filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
                             & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)))
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(
        F.desc("count"), "n").limit(1).collect()
    if length:
        rows = rows.filter(F.size("vector") == length[0]["n"])
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def _packed(rows: DataFrame) -> DataFrame:
    """(node, full binary, code binary, scale float) from (node, vector)."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            full = b.column("vector").flatten().to_numpy(zero_copy_only=False)
            full = full.reshape(b.num_rows, -1)
            scale = np.abs(full).max(axis=1) / CODE_MAX
            code = np.rint(full / np.maximum(scale, 1e-300)[:, None]).astype(np.int16)
            yield pa.RecordBatch.from_arrays(
                [b.column("node"), pa.array([x.tobytes() for x in full], pa.binary()),
                 pa.array([x.tobytes() for x in code], pa.binary()),
                 pa.array(scale.astype(np.float32))], names=["node", "full", "code", "scale"])
    return rows.select("node", "vector").mapInArrow(
        run, "node long, full binary, code binary, scale float")


def _decode(code: pa.Array, scale: pa.Array) -> np.ndarray:
    """Float vectors of a code column whose values have one length."""
    raw = b"".join(code.to_pylist())
    return (np.frombuffer(raw, np.int16).reshape(len(code), -1).astype(np.float32)
            * scale.to_numpy(zero_copy_only=False).astype(np.float32)[:, None])


def _squares(x: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to one another; taken around their mean, so that
    near-equal vectors far from the origin keep their precision."""
    x = x - x.mean(axis=0)
    n = (x * x).sum(axis=1)
    return np.maximum(n[:, None] + n[None, :] - 2 * (x @ x.T), 0)


def _nearest(edges: DataFrame, degree: int) -> DataFrame:
    """(node, other, d, new): each node's nearest, without repetitions; an edge that was
    there before is not new."""
    once = edges.groupBy("node", "other").agg(F.min("d").alias("d"), F.min("new").alias("new"))
    order = Window.partitionBy("node").orderBy("d", "other")
    return (once.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= degree).drop("rank"))


def first_graph(vectors: DataFrame, count: int) -> DataFrame:
    """(node, other, d) from brute force within random-hyperplane cells."""
    planes = max(0, math.ceil(math.log2(max(count, 1) / LEAF)))
    if planes:
        sample = vectors.orderBy(F.xxhash64("node")).limit(SAMPLE).select("code", "scale").toArrow()
        points = _decode(sample["code"].combine_chunks(), sample["scale"].combine_chunks())
        normals = np.random.default_rng(7).standard_normal(
            (points.shape[1], TREES * planes)).astype(np.float32)
        medians = np.median(points @ normals, axis=0)
        powers = 1 << np.arange(planes)
    trees = TREES if planes else 1

    def cells(batches):
        for b in batches:
            if not b.num_rows:
                continue
            side = (_decode(b.column("code"), b.column("scale")) @ normals > medians) \
                if planes else None
            for t in range(trees):
                cell = side[:, t * planes:(t + 1) * planes] @ powers if planes \
                    else np.zeros(b.num_rows, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b.num_rows, t, np.int64)), pa.array(cell.astype(np.int64)),
                     b.column("node"), b.column("code"), b.column("scale")],
                    names=["tree", "cell", "node", "code", "scale"])
    dealt = vectors.select("node", "code", "scale").mapInArrow(
        cells, "tree long, cell long, node long, code binary, scale float")
    sizes = dealt.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("size"))
    split = (dealt.join(sizes, ["tree", "cell"])
             .withColumn("part", F.pmod(F.xxhash64("node", "tree"),
                                        F.ceil(F.col("size") / F.lit(2 * LEAF)).cast("long"))))

    def brute(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _decode(pa.array(pdf["code"], pa.binary()), pa.array(pdf["scale"]))
        d, node = _squares(x), pdf["node"].to_numpy()
        np.fill_diagonal(d, np.inf)
        k = min(CELL_NEIGHBOURS if planes else DEGREE, len(node) - 1)
        if k < 1:
            return pd.DataFrame({"node": [], "other": [], "d": []})
        at = np.argpartition(d, k - 1, axis=1)[:, :k]
        return pd.DataFrame({"node": np.repeat(node, k), "other": node[at.ravel()],
                             "d": np.take_along_axis(d, at, 1).ravel()})
    edges = (split.select("tree", "cell", "part", "node", "code", "scale")
             .groupBy("tree", "cell", "part")
             .applyInPandas(brute, "node long, other long, d float"))
    return _nearest(edges.withColumn("new", F.lit(True)), DEGREE)


def _both_ways(graph: DataFrame) -> DataFrame:
    """(node, other, new): graph neighbours, and the DEGREE nearest that have the node as one."""
    back = graph.select(F.col("other").alias("node"), F.col("node").alias("other"), "d", "new")
    order = Window.partitionBy("node").orderBy("d", "other")
    back = back.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= DEGREE)
    return (graph.select("node", "other", "new").union(back.select("node", "other", "new"))
            .groupBy("node", "other").agg(F.max("new").alias("new")))


def descend(graph: DataFrame, vectors: DataFrame) -> DataFrame:
    """One round of NN-descent: neighbours of each node are compared with one another."""
    last = graph.groupBy("node").agg(F.max("d").alias("last"), F.count("d").alias("n")).select(
        F.col("node").alias("other"), F.when(F.col("n") >= DEGREE, F.col("last")).alias("last"))
    carried = vectors.select(F.col("node").alias("other"), "code", "scale").join(
        last, "other", "left")
    edges = _both_ways(graph)
    stirred = edges.filter("new").select("node").distinct()
    itself = vectors.select("node", F.col("node").alias("other"), F.lit(False).alias("new"))
    gathered = (edges.union(itself).join(stirred, "node", "left_semi")
                .join(carried, "other").groupBy("node")
                .agg(F.collect_list(F.struct("other", "code", "scale", "last", "new"))
                     .alias("near")))

    def local_join(batches):
        for b in batches:
            lists = b.column("near")
            flat, offsets = lists.flatten(), lists.offsets.to_numpy()
            if not len(flat):
                continue
            offsets = offsets - offsets[0]
            x = _decode(flat.field("code"), flat.field("scale"))
            ids = flat.field("other").to_numpy()
            last = flat.field("last").fill_null(float("inf")).to_numpy()
            new = flat.field("new").to_numpy(zero_copy_only=False)
            node, other, ds = [], [], []
            for lo, hi in zip(offsets.tolist(), offsets[1:].tolist()):
                d = _squares(x[lo:hi])
                better = (d < last[lo:hi, None]) & (new[lo:hi, None] | new[None, lo:hi])
                np.fill_diagonal(better, False)
                i, j = np.nonzero(better)
                node.append(ids[lo + i])
                other.append(ids[lo + j])
                ds.append(d[i, j])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(node)), pa.array(np.concatenate(other)),
                 pa.array(np.concatenate(ds).astype(np.float32))], names=["node", "other", "d"])
    found = gathered.select("near").mapInArrow(local_join, "node long, other long, d float")
    return _nearest(graph.withColumn("new", F.lit(False))
                    .union(found.withColumn("new", F.lit(True))), DEGREE)


def build(vectors: DataFrame, count: int) -> DataFrame:
    """The neighbour graph (node, other, d); d is the squared distance of the codes."""
    graph = stored(first_graph(vectors, count), "graph")
    changed = count > LEAF                               # else the first graph is exact
    while changed:
        graph = stored(descend(graph, vectors), "graph")
        edges = graph.agg(F.count(F.lit(1)).alias("n"), F.count_if("new").alias("new")).first()
        changed = edges["new"] > CHANGED * edges["n"]
    return graph


def _measure(rows: DataFrame) -> DataFrame:
    """(query, node, d) from (query, node, q_code, q_scale, code, scale, limit)."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            diff = _decode(b.column("q_code"), b.column("q_scale")) \
                - _decode(b.column("code"), b.column("scale"))
            d = np.einsum("ij,ij->i", diff, diff)
            keep = d < b.column("limit").fill_null(float("inf")).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b.column("query").filter(pa.array(keep)), b.column("node").filter(pa.array(keep)),
                 pa.array(d[keep].astype(np.float32))], names=["query", "node", "d"])
    return rows.select("query", "node", "q_code", "q_scale", "code", "scale", "limit").mapInArrow(
        run, "query long, node long, d float")


def search(graph: DataFrame, vectors: DataFrame, queries: DataFrame) -> DataFrame:
    """(query, node, d): the beam of each query; ``queries`` has the column query, a node."""
    near = stored(_both_ways(graph).groupBy("node").agg(F.collect_list("other").alias("near")),
                  "adjacency")
    asked = stored(queries.join(vectors.select(
        F.col("node").alias("query"), F.col("code").alias("q_code"),
        F.col("scale").alias("q_scale")), "query"), "queries")
    beam = asked.select("query", F.col("query").alias("node"), F.lit(0.0).cast("float").alias("d"),
                        F.lit(False).alias("done"))
    order = Window.partitionBy("query").orderBy("d", "node")
    while True:
        reached = (beam.filter(~F.col("done")).join(near, "node")
                   .select("query", F.explode("near").alias("node")).distinct()
                   .join(beam.select("query", "node"), ["query", "node"], "left_anti"))
        limit = beam.groupBy("query").agg(F.max("d").alias("far"), F.count("d").alias("n")).select(
            "query", F.when(F.col("n") >= BEAM, F.col("far")).alias("limit"))
        found = _measure(reached.join(vectors.select("node", "code", "scale"), "node")
                         .join(asked.join(limit, "query"), "query"))
        beam = stored(beam.withColumn("done", F.lit(True))
                      .union(found.withColumn("done", F.lit(False)))
                      .withColumn("rank", F.row_number().over(order))
                      .filter(F.col("rank") <= BEAM).drop("rank"), "beam")
        if beam.filter(~F.col("done")).limit(1).count() == 0:
            break
    return beam.select("query", "node", "d")


def nearest(df: DataFrame, asked, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding"
            ) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that the expression ``asked`` of vec_id
    selects, against all others."""
    double = df.schema[vector].dataType.elementType == T.DoubleType()
    kind = np.float64 if double else np.float32
    rows = stored(usable(df, vec_id, vector)
                  .withColumn("same", F.xxhash64("vector"))
                  .withColumn("same2", F.xxhash64(F.reverse("vector"))), "vectors")
    key = ["same", "same2"]
    nodes = rows.groupBy(*key).agg(F.min("vec_id").alias("node"),
                                   F.first("vector").alias("vector"))
    vectors = stored(_packed(nodes), "nodes")
    names = nodes.select(*key, "node")
    # of equal vectors, the k + 1 smallest ids can be among anyone's k nearest
    order = Window.partitionBy(*key).orderBy("vec_id")
    members = stored(rows.select("vec_id", *key).withColumn("rank", F.row_number().over(order))
                     .filter(F.col("rank") <= k + 1).join(names, key).select("node", "vec_id"),
                     "members")
    asking = stored(rows.filter(asked(F.col("vec_id"))).join(names, key)
                    .select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")),
                    "asking")
    graph = build(vectors, vectors.count())
    beam = search(graph, vectors, asking.select("query").distinct())
    by_d = Window.partitionBy("query").orderBy("d", "node")
    best = (beam.withColumn("rank", F.row_number().over(by_d))
            .filter(F.col("rank") <= max(RESCORE, 4 * k)).select("query", "node"))
    pairs = (best.join(vectors.select("node", "full"), "node")
             .join(vectors.select(F.col("node").alias("query"), F.col("full").alias("q")), "query"))

    def exact(batches):
        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), kind)
                    .reshape(b.num_rows, -1).astype(np.float64) if b.num_rows else np.empty((0, 1))
                    for c in ("q", "full"))
            yield pa.RecordBatch.from_arrays(
                [b.column("query"), b.column("node"), pa.array(np.sqrt(((x - y) ** 2).sum(axis=1)))],
                names=["query", "node", "score"])
    scored = pairs.select("query", "node", "q", "full").mapInArrow(
        exact, "query long, node long, score double")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (asking.join(scored, "query").join(members, "node")
            .filter(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
