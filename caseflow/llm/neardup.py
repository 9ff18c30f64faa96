"""Near-duplicate documents: MinHash with banding, signature and set verification, connected components.

A document's set holds its distinct shingles of ``size`` words; a shorter document's one shingle is all of
its words. Documents are linked if the Jaccard similarity of their sets is at least ``percent`` / 100.

1. Each text becomes minima of universal hash functions (a*x + b modulo 2**32 over 32 mixed bits of a
   shingle). Bands of ``rows`` minima are the bucket keys. The number of bands follows from the threshold:
   a pair at the threshold shares no bucket with a chance of at most ``miss``.
2. Equal sets are one node, named by their smallest document id.
3. In each bucket every node is paired with one centre, not with every other node. Pairs are tested first on
   signatures (one byte of each minimum), then on the full sets.
4. Links give components. Nodes with a common centre may still be linked across components: where a centre's
   nodes are not all in one, they meet in tiles of bounded size, and full sets are compared there. A tile gives back
   a spanning part of its links, not all pairs. So no link between different sets is lost to a bucket's size.

Defined results. Null or wordless texts have an empty set and are linked with nothing. Rows with a null id
are linked with nothing and are kept. Rows that share an id count as one document when links are followed.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from caseflow.llm import words as w
from caseflow.llm.components import connected_components
from caseflow.llm.tables import likely_rows, materialize, text_key, without_rows

ROWS = 6
MISS = 1e-6
#: Standard deviations by which a signature may fall short of the threshold before its pair is dropped.
SLACK = 6.0
PART = 4096
TILE = 256
TILE_BYTES = 1 << 24


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


@lru_cache(4)
def _functions(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    draw = np.random.Generator(np.random.PCG64(7))
    a = draw.integers(0, 2**31, (n, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, draw.integers(0, 2**32, (n, 1), dtype=np.uint32), draw.integers(0, 2**63, n, dtype=w.U64) * w.U64(2) + w.U64(1)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's distinct shingles as sorted hashes."""
    hashes, at = w.word_hashes(column, w.NON_SPACE)
    runs = w.shingles(hashes, size)
    sets = []
    for k in range(len(column)):
        n = int(at[k + 1] - at[k])
        if n >= size:
            sets.append(np.unique(runs[at[k] : at[k + 1] - size + 1]))
        else:
            sets.append(w.shingles(hashes[at[k] : at[k + 1]], n) if n else np.empty(0, w.U64))
    return sets


def set_name(found: np.ndarray) -> tuple[int, int]:
    """128 bits that name a set."""
    return int(w.mix(found).sum(dtype=w.U64).view(np.int64)), int(w.mix(found ^ w.U64(0x5851F42D4C957F2D)).sum(dtype=w.U64).view(np.int64))


def minima(found: np.ndarray, n: int) -> np.ndarray:
    a, b, _ = _functions(n)
    x, least = (found >> w.U64(32)).astype(np.uint32), np.full(n, 2**32 - 1, np.uint32)
    for k in range(0, len(x), PART):
        np.minimum(least, (a * x[k : k + PART] + b).min(axis=1), out=least)
    return least


def signatures(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, set_a, set_b, keys, signature`` for each row of ``doc_id, text``."""
    schema = "doc_id long, text_key long, n_shingles long, set_a long, set_b long, keys array<long>, signature binary"

    def sign(batches):
        odd = _functions(bands * rows)[2].reshape(bands, rows)
        for batch in w.small_batches(batches, "text"):
            sets = shingle_sets(batch.column(2), size)
            names = [set_name(s) for s in sets]
            keys, signature = [], []
            for s in sets:
                if len(s):
                    least = minima(s, bands * rows)
                    keys.append(w.mix((least.reshape(bands, rows) * odd).sum(axis=1, dtype=w.U64) + np.arange(bands, dtype=w.U64)).view(np.int64))
                    signature.append(((least * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes())
                else:
                    keys.append(None)
                    signature.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([x for x, _ in names], pa.int64()), pa.array([y for _, y in names], pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())), pa.array(signature, pa.binary()),
                ],
                [f.split()[0] for f in schema.split(", ")],
            )

    return docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text").mapInArrow(sign, schema)


def _similar_signatures(pairs: DataFrame, nodes: DataFrame, percent: int, n: int) -> DataFrame:
    """The pairs whose signatures agree in as many places as the threshold lets expect, less the slack."""
    share = percent / 100
    agree = share + (1 - share) / 256
    least = n * (agree - SLACK * math.sqrt(agree * (1 - agree) / n))

    def near(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, n) for k in (2, 3))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array((a == b).sum(axis=1) >= least))

    left = nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(near, "a long, b long")


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``node, shingles``: the full sets of the wanted nodes, as sorted hashes."""

    def sets(batches):
        for batch in w.small_batches(batches, "text"):
            found = shingle_sets(batch.column(1), size)
            names = [set_name(s) for s in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array([x for x, _ in names], pa.int64()), pa.array([y for _, y in names], pa.int64()),
                    pa.array([s.tobytes() for s in found], pa.binary()),
                ],
                ["node", "set_a", "set_b", "shingles"],
            )

    texts = likely_rows(docs.select("doc_id", "text"), "doc_id", wanted.withColumnRenamed("node", "doc_id"))
    named = nodes.join(wanted, "node", "left_semi").select("node", "set_a", "set_b")
    found = texts.mapInArrow(sets, "node long, set_a long, set_b long, shingles binary")
    return found.join(named, ["node", "set_a", "set_b"], "left_semi").dropDuplicates(["node"]).select("node", "shingles")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""

    def similar(batches):
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), w.U64), np.frombuffer(y.as_buffer(), w.U64)
                if len(x) > len(y):
                    x, y = y, x
                if 100 * len(x) < percent * len(y):
                    linked.append(False)
                    continue
                shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(linked, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(similar, "a long, b long")


def _circles(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """``centre, node``: with each bucket's centre, the nodes that meet in its buckets.

    A bucket's centre is its most central node, the one whose buckets hold most nodes in all. Copies of one
    text thus have the same centre in nearly all of their buckets, and one that most of them are close to.
    """
    degree = members.join(sizes, "key").groupBy("node").agg(F.sum("n").alias("degree"))
    order = F.struct((-F.col("degree")).alias("d"), F.xxhash64("node").alias("h"), F.col("node").alias("centre"))
    centres = members.join(materialize(degree, "degrees"), "node").groupBy("key").agg(F.min(order)["centre"].alias("centre"))
    return members.join(materialize(centres, "centres"), "key").select("centre", "node").distinct()


def _linked_inside(tile: pa.Table, percent: int) -> pa.Table:
    """``a, b``: links that join the linked nodes of a tile, the smallest node of each part with the others."""
    order = np.argsort(tile.column("node").to_numpy(), kind="stable")
    nodes, comps = tile.column("node").to_numpy()[order], tile.column("comp").to_numpy()[order]
    if len(np.unique(comps)) < 2:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    column = tile.column("shingles").combine_chunks()
    sets = [np.frombuffer(column[int(k)].as_buffer(), w.U64) for k in order]
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    kinds, place = np.unique(flat, return_inverse=True)
    by_kind = np.argsort(place, kind="stable")
    place, owner, shared = place[by_kind], owner[by_kind], np.zeros((len(sets), len(sets)))
    for low in range(0, len(kinds), PART):
        first, last = np.searchsorted(place, [low, low + PART])
        held = np.zeros((len(sets), min(PART, len(kinds) - low)), np.float32)
        held[owner[first:last], place[first:last] - low] = 1
        shared += held @ held.T
    linked = (100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)) | (comps[:, None] == comps[None, :])
    least = np.arange(len(nodes))
    while True:  # smallest reachable place
        lower = np.where(linked, least[None, :], len(nodes)).min(axis=1)
        lower = np.minimum(lower, lower[lower])
        if (lower == least).all():
            break
        least = lower
    apart = comps[least] != comps
    return pa.table({"a": nodes[least][apart], "b": nodes[apart]})


def _open_links(circles: DataFrame, comps: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """Links across components between nodes of a circle; None if no circle has several components.

    A circle's nodes are dealt to tiles of about TILE nodes and TILE_BYTES of sets, and each two tiles meet in one
    task, which compares the full sets and gives back a spanning part of the links. Every pair of nodes with a
    common bucket is compared, unless both are in one component already.
    """
    labelled = circles.join(comps, "node", "left").select("centre", "node", F.coalesce("component", "node").alias("comp"))
    labelled = materialize(labelled.join(nodes.select("node", "n_shingles"), "node"), "circles")
    seen = Observation()
    spread = labelled.groupBy("centre").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("n"), F.sum("n_shingles").alias("s")
    ).where("low <> high")
    tiles = F.ceil(F.greatest(F.col("n") / TILE, F.col("s") * 8 / TILE_BYTES)).cast("int")
    spread = materialize(spread.select("centre", tiles.alias("tiles")).observe(seen, F.count("*").alias("n")), "open")
    if not seen.get["n"]:
        return None
    own = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")
    placed = labelled.join(spread, "centre").withColumn("own", own)
    both = F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda t: F.struct(F.least(t, "own").alias("i"), F.greatest(t, "own").alias("j")))
    met = placed.select("centre", "node", "comp", F.explode(both).alias("t")).select("centre", "node", "comp", "t.i", "t.j")
    whole = met.join(sets, "node")
    return whole.groupBy("centre", "i", "j").applyInArrow(lambda tile: _linked_inside(tile, percent), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, rows: int = ROWS, miss: float = MISS) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` for each row of ``docs`` (columns doc_id long, text string)."""
    bands = bands_for(percent, rows, miss)
    signed = materialize(signatures(docs, size, bands, rows), "signatures")
    name = ["n_shingles", "set_a", "set_b"]
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    groups = materialize(usable.groupBy(*name).agg(F.min("doc_id").alias("node")), "groups")
    nodes = materialize(
        usable.join(groups.withColumnRenamed("node", "doc_id"), [*name, "doc_id"], "left_semi")
        .dropDuplicates([*name, "doc_id"]).withColumnRenamed("doc_id", "node"),
        "nodes",
    )
    spread = nodes.select("node", F.explode("keys").alias("key"))
    shared = materialize(spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "keys")
    members = materialize(spread.join(shared.select("key"), "key", "left_semi"), "members")
    circles = materialize(_circles(members, shared), "circles")
    sets = materialize(_sets(docs, nodes, circles.select("node").distinct(), size), "sets")
    pairs = circles.where("centre <> node").select(F.col("node").alias("a"), F.col("centre").alias("b"))
    near = materialize(_similar_signatures(pairs, nodes, percent, bands * rows), "near")
    links = materialize(_confirmed(near, sets, percent), "links")
    comps = connected_components(links)
    more = _open_links(circles, comps, nodes, sets, percent)
    if more is not None:
        comps = connected_components(links.unionByName(more))
    labels = groups.join(comps, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
    result = signed.select("doc_id", "text_key", *name).join(labels.select(*name, "component_id"), name, "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select("doc_id", "text_key", "n_shingles", own.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each component, whole rows; equal rows count once."""
    found = materialize(near_duplicates(docs, **options), "near-duplicates")
    named = found.where("doc_id IS NOT NULL")
    gone = named.where("NOT kept").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), F.lit(False).alias("again"))
    again = named.where("kept").groupBy("doc_id", "text_key").count().where("count > 1")
    again = again.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"), F.lit(True).alias("again"))
    return without_rows(docs, "doc_id", "text", gone.unionByName(again))
