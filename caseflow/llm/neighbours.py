"""Approximate nearest neighbours by inner product, with shifted space-filling curves.

Every curve projects the vectors to a few random directions, shifts them, and orders them along a Hilbert curve. Spark sorts
the rows of each curve by their key (a range partitioning); a row's place in that order is its rank. A query meets
the candidates within ``share`` / 2 of the table on each side of its rank, on every curve; what the curves find is merged
and reranked by the exact product of the original vectors.

Longer vectors may have larger products, so candidates get one more coordinate that brings all to one length, and queries
a zero there; the largest product is then the smallest distance.

Equal vectors are one node with its k + 1 smallest ids; no further copy can be among the k nearest. Curves order nodes, and
a query's own node is always a candidate. Ids take the places of nodes in the final ranking.

Candidates lie in tiles of at most ``tile`` rows; a query goes to each tile that its window touches. Tiles hold equally
many nodes whatever the keys, so no task gets more than a tile and the query nodes sent to it. Each
tile gives back k + 1 nodes a query node (times the most vectors that one id has). Windows are a share of the table so that recall depends on the data's shape, not on its
size: vectors without structure need wide windows (see README), clustered ones narrower.

Defined results. Vectors that are null, zero, or hold null or non-finite components take no part, neither do null ids and
vectors whose length is not the most frequent one (the larger one if several are). Rows equal in id and vector count once.
Ties go to the smaller id. A query without candidates has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.llm.mixing import positions
from caseflow.llm.tables import materialize
from caseflow.operators.ranks import top_n

CURVES = 12
SHARE = 0.125
TILE = 4096
DIRECTIONS = 4
BITS = 12
SEED = 11
FOUND = "q_id long, q_h long, id long, h long, low long, score double"


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of whole coordinates (rows) below 2**bits.

    The published method of exchanging and inverting the low bits, then a Gray code over the interleaved bits.
    """
    x = cells.astype(np.int64).copy()
    n, d = x.shape
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for k in range(d):
            high = (x[:, k] >> level & 1).astype(bool)
            swap = np.where(high, 0, (x[:, 0] ^ x[:, k]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, k] ^= swap
    for k in range(1, d):
        x[:, k] ^= x[:, k - 1]
    turn = np.zeros(n, np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[:, -1] >> level & 1, (1 << level) - 1, 0)
    x ^= turn[:, None]
    key = np.zeros(n, np.int64)
    for level in range(bits - 1, -1, -1):
        for k in range(d):
            key = key << 1 | (x[:, k] >> level & 1)
    return key


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id, v``: the rows that take part, each once."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite).where(F.exists("v", lambda x: x != 0))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1)
    chosen = lengths.collect()
    return rows.where(F.size("v") == (chosen[0]["d"] if chosen else 0)).distinct()


def _curve_keys(rows: DataFrame, radius: float, curves: int, directions: int, bits: int, seed: int) -> DataFrame:
    """``curve, key, id, h, is_query`` for candidates, and again for queries."""

    def place(batches):
        for batch in batches:
            ids, marks, query = batch.column(0), batch.column(1), np.array(batch.column(2).to_pylist(), bool)
            x = np.array(batch.column(3).to_pylist(), np.float64)
            if not len(x):
                continue
            x = np.vstack([x, x[query]]) / radius
            rest = np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))
            rest[len(query):] = 0.0
            x = np.c_[x, rest]
            ids = np.r_[ids.to_numpy(), ids.to_numpy()[query]]
            marks = np.r_[marks.to_numpy(), marks.to_numpy()[query]]
            asks = np.arange(len(x)) >= len(query)
            for curve in range(curves):
                draw = np.random.Generator(np.random.PCG64(seed * 1000 + curve))
                basis, _ = np.linalg.qr(draw.normal(size=(x.shape[1], min(directions, x.shape[1]))))
                cells = ((x @ basis + 1) / 2 + draw.random(basis.shape[1])) / 2 * (1 << bits)
                key = hilbert_key(np.clip(cells.astype(np.int64), 0, (1 << bits) - 1), bits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), curve, np.int32)), pa.array(key), pa.array(ids), pa.array(marks), pa.array(asks)],
                    ["curve", "key", "id", "h", "asks"],
                )

    return rows.select("id", "h", "is_query", "v").mapInArrow(place, "curve int, key long, id long, h long, asks boolean")


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * b).sum(axis=1)  # the same sum for a pair wherever it is met


def _best(k: int):
    """For a tile of candidate and query nodes: each query's k best candidates."""

    def search(tile: pa.Table) -> pa.Table:
        asks = tile.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        ids, marks, low = (tile.column(c).to_numpy() for c in ("id", "h", "low"))
        vectors = tile.column("v").combine_chunks()
        x = np.asarray(vectors.flatten(), np.float64).reshape(len(ids), -1) if len(ids) else np.empty((0, 1))
        there, asked = np.flatnonzero(~asks), np.flatnonzero(asks)
        there = there[np.lexsort((ids[there], low[there]))]
        candidates, found = x[there], [[], [], []]
        for first in range(0, len(asked), 256):
            part = asked[first : first + 256]
            for row, at in zip(x[part] @ candidates.T, part, strict=True):
                if len(row) > k:
                    near = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k] - 1e-9 * (1 + np.abs(row).max()))
                else:
                    near = np.arange(len(row))
                exact = _products(candidates[near], x[at])
                top = np.argsort(-exact, kind="stable")[:k]
                found[0].append(np.full(len(top), at))
                found[1].append(there[near][top])
                found[2].append(exact[top])
        q, c, score = (np.concatenate(y) if y else np.empty(0) for y in found)
        q, c = q.astype(np.int64), c.astype(np.int64)
        return pa.table({"q_id": ids[q], "q_h": marks[q], "id": ids[c], "h": marks[c], "low": low[c], "score": score.astype(np.float64)})

    return search


def _own(nodes: DataFrame) -> DataFrame:
    """Each query node as its own candidate."""

    def rate(batches):
        for batch in batches:
            x = np.array(batch.column(3).to_pylist(), np.float64)
            if len(x):
                node = list(batch.columns[:2])
                yield pa.RecordBatch.from_arrays([*node, *node, batch.column(2), pa.array(_products(x, x))], ["q_id", "q_h", "id", "h", "low", "score"])

    return nodes.where("is_query").select("id", "h", "low", "v").mapInArrow(rate, FOUND)


def nearest(
    vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", curves: int = CURVES,
    share: float = SHARE, tile: int = TILE, directions: int = DIRECTIONS, bits: int = BITS, seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k largest products found. ``is_query`` is a condition on ``id``."""
    rows = usable(vectors, id_col, vector_col).withColumn("is_query", F.coalesce(is_query, F.lit(False))).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # no -0
    rows = materialize(rows.select(F.col("id").alias("vec"), F.xxhash64(F.lit(seed), "v").alias("id"), F.xxhash64("v").alias("h"), "v", "is_query"), "vectors")
    node = ["id", "h"]
    copies = top_n(rows.select(*node, "vec"), node, ["vec"], k + 1, "vec").groupBy(*node).agg(F.sort_array(F.collect_list("vec")).alias("ids"))
    nodes = rows.groupBy(*node).agg(F.first("v").alias("v"), F.max("is_query").alias("is_query")).join(copies, node)
    nodes = materialize(nodes.withColumn("low", F.get("ids", F.lit(0))), "nodes")
    most = rows.groupBy("vec").count().agg(F.max("count")).first()[0] or 1
    wide = (k + 1) * most
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    radius, n = nodes.agg(F.max(length), F.count("*")).first()
    keys = _curve_keys(nodes, (radius or 1.0) * (1 + 1e-12), curves, directions, bits, seed)
    placed = positions(keys, [F.col(c) for c in ("curve", "key", "id", "h", "asks")], "place")
    entries = n + nodes.where("is_query").count()
    half = max(1, int(entries * share / 2))
    size = min(tile, half)
    rank = F.col("place") - F.col("curve") * entries
    touched = F.sequence(
        F.greatest(F.lit(0), F.floor((rank - half) / size)), F.least(F.lit(max(0, entries - 1) // size), F.floor((rank + half) / size))
    )
    tiles = placed.select("curve", *node, "asks", F.explode(F.when(F.col("asks"), touched).otherwise(F.array(F.floor(rank / size)))).alias("tile"))
    whole = tiles.join(nodes.select(*node, "low", "v"), node).select("curve", "tile", "asks", *node, "low", "v")
    found = whole.groupBy("curve", "tile").applyInArrow(_best(wide), FOUND).unionByName(_own(nodes))
    once = found.groupBy("q_id", "q_h", *node, "low").agg(F.max("score").alias("score"))
    asker = W.partitionBy("q_id", "q_h")
    near = once.withColumn("r", F.row_number().over(asker.orderBy(F.desc("score"), "low", *node))).where(F.col("r") <= wide)
    named = near.join(nodes.select(*node, "ids"), node).select("q_id", "q_h", "score", F.explode("ids").alias("vec_id"))
    named = named.groupBy("q_id", "q_h", "vec_id").agg(F.max("score").alias("score"))
    named = named.withColumn("r", F.row_number().over(asker.orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    answers = named.groupBy("q_id", "q_h").agg(F.collect_list(F.struct("vec_id", "score")).alias("found"))
    askers = rows.where("is_query").select(F.col("vec").alias("query_id"), F.col("id").alias("q_id"), F.col("h").alias("q_h"))
    each = askers.join(answers, ["q_id", "q_h"]).select("query_id", F.inline("found")).where("vec_id <> query_id")
    each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def report(vectors: DataFrame, k: int = 20) -> DataFrame:
    """The k nearest rows of every row whose id is divisible by 20."""
    return nearest(vectors, F.col("id") % 20 == 0, k)
