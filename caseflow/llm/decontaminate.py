"""Benchmark decontamination: which words of a document also stand in a benchmark item, in a row.

A window is ``window`` consecutive words of an item; a shorter item is one window. The search is a
prefix-filtered set join with containment 1. A window's shingles are ordered by how often they occur
in all documents, and only the rarest one (the prefix that containment 1 needs) is looked up in the
documents. Its place fixes where the window would begin (the positional bound); the window must fit
between the ends of the document (the length bound); then all of its words are compared.

Documents never move: each task looks its own rows up. The items come in blocks of at most
``block_windows`` windows, so that what is broadcast has that bound; every block meets every document.

Defined results. A null text or a text without words has no words and no hits. Items with a null id,
a null text or no words take no part; items that share an id are one item. Repeated document rows stay
repeated, each with its result. All columns of the documents are kept as they are; the added columns
are renamed with underscores if the documents have columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm import words as w
from caseflow.llm.tables import distinct_name, materialize

BITS = 22
COMPARED = 1 << 17


@dataclass
class WindowIndex:
    """A block of windows by the shingle that is looked up for them, per shingle size."""

    size: int
    keys: np.ndarray  # sorted shingle hashes, one for each window
    offset: np.ndarray  # the shingle's place in its window
    length: np.ndarray
    words: np.ndarray  # windows x words, 0 beyond the length
    item: np.ndarray  # place in the list of items
    seen: np.ndarray  # flags by the shingle's leading bits

    def occurrences(self, hashes: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Where windows begin in ``hashes`` and which windows, for texts that start at ``at``."""
        found = w.shingles(hashes, self.size)
        places = np.flatnonzero(self.seen[found >> w.U64(64 - BITS)])
        low = np.searchsorted(self.keys, found[places], "left")
        count = np.searchsorted(self.keys, found[places], "right") - low
        for first, last in _parts(count):
            n = count[first:last]
            window = np.repeat(low[first:last] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            start = np.repeat(places[first:last], n) - self.offset[window]
            text = np.searchsorted(at, np.repeat(places[first:last], n), "right") - 1
            fits = (start >= at[text]) & (start + self.length[window] <= at[text + 1])
            start, window = start[fits], window[fits]
            within = np.arange(self.words.shape[1])[None, :] < self.length[window][:, None]
            there = hashes[np.minimum(start[:, None] + np.arange(self.words.shape[1]), len(hashes) - 1)]
            equal = ((there == self.words[window]) | ~within).all(axis=1)
            yield start[equal], window[equal]


def _parts(count: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of a list so that each part stands for about COMPARED comparisons."""
    total = np.cumsum(count)
    first = 0
    while first < len(count):
        done = total[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(total, done + COMPARED, "right")))
        yield first, last
        first = last


def item_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item string, words binary``: the distinct windows of each item, as 64-bit word hashes."""

    def cut(batches):
        for batch in w.small_batches(batches, "text"):
            hashes, at = w.word_hashes(batch.column(1), w.ALPHANUMERIC)
            names, found = [], []
            for k, name in enumerate(batch.column(0).to_pylist()):
                own = hashes[at[k] : at[k + 1]]
                for s in range(max(1, len(own) - window + 1) if len(own) else 0):
                    names.append(name)
                    found.append(own[s : s + window].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(found, pa.binary())], ["item", "words"])

    named = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return named.where("item IS NOT NULL AND text IS NOT NULL").mapInArrow(cut, "item string, words binary").distinct()


def _shingle_counts(docs: DataFrame, text_col: str, wanted: dict[int, np.ndarray]) -> dict[tuple[int, int], int]:
    """How often each wanted shingle occurs in all documents: at most as many rows as are wanted."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def count(batches):
        for batch in w.small_batches(batches, text_col):
            hashes, at = w.word_hashes(batch.column(0), w.ALPHANUMERIC)
            for size, keys in shared.value.items():
                found = w.shingles(hashes, size)
                inside = np.ones(len(found), bool)
                for back in range(1, size):  # runs that would cross the end of a text
                    ends = at[1:-1] - back
                    inside[ends[(ends >= 0) & (ends < len(found))]] = False
                place = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
                hit, n = np.unique(place[inside & (keys[place] == found)], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(hit), size, np.int32)), pa.array(keys[hit].view(np.int64)), pa.array(n.astype(np.int64))],
                    ["size", "shingle", "n"],
                )

    counts = docs.select(text_col).mapInArrow(count, "size int, shingle long, n long")
    rows = counts.groupBy("size", "shingle").agg(F.sum("n").alias("n")).collect()
    return {(r["size"], r["shingle"]): r["n"] for r in rows}


def _index(docs: DataFrame, text_col: str, block: list, shingle: int, window: int) -> tuple[list[str], list[WindowIndex]]:
    """Look-up tables for one block of windows."""
    by_size: dict[int, list[tuple[str, np.ndarray]]] = {}
    for row in block:
        own = np.frombuffer(row["words"], w.U64)
        by_size.setdefault(min(shingle, len(own)), []).append((row["item"], own))
    parts = {size: [w.shingles(own, size) for _, own in found] for size, found in by_size.items()}
    n = _shingle_counts(docs, text_col, {size: np.unique(np.concatenate(x)) for size, x in parts.items()})
    names = sorted({row["item"] for row in block})
    number = {name: k for k, name in enumerate(names)}
    tables = []
    for size, found in by_size.items():
        rarest = [min(range(len(s)), key=lambda k, s=s: (n.get((size, int(s[k].view(np.int64))), 0), int(s[k]))) for s in parts[size]]
        keys = np.array([s[k] for s, k in zip(parts[size], rarest, strict=True)], w.U64)
        matrix = np.zeros((len(found), window), w.U64)
        for k, (_, own) in enumerate(found):
            matrix[k, : len(own)] = own
        order = np.argsort(keys, kind="stable")
        seen = np.zeros(1 << BITS, bool)
        seen[keys >> w.U64(64 - BITS)] = True
        tables.append(WindowIndex(
            size, keys[order], np.array(rarest)[order], np.array([len(own) for _, own in found])[order], matrix[order],
            np.array([number[name] for name, _ in found])[order], seen,
        ))
    return names, tables


def find_items(
    docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", block_windows: int = 500_000, keep: list[str] | None = None,
) -> DataFrame:
    """The documents with ``n_words``, the hit word runs ``hit_from``/``hit_to`` (end exclusive) and ``item_ids``.

    ``keep`` lists the document columns of the result; all by default.
    """
    windows = materialize(item_windows(items, window, item_col, item_text_col), "windows")
    blocks = max(1, -(-windows.count() // block_windows))
    numbered = windows.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks)))
    keep = list(docs.columns) if keep is None else keep
    carried = list(dict.fromkeys([*keep, text_col]))
    names = [distinct_name(docs.columns, x) for x in ("n_words", "hit_from", "hit_to", "item_ids")]
    kinds = [T.LongType(), *[T.ArrayType(T.IntegerType())] * 2, T.ArrayType(T.StringType())]
    result = docs.select(*carried)
    for column, kind in zip(names, kinds, strict=True):
        result = result.withColumn(column, F.lit(None).cast(kind))
    for k in range(blocks):
        block = numbered.where(F.col("block") == k).collect()
        result = result.mapInArrow(_matcher(docs, _index(docs, text_col, block, shingle, window), text_col, names), result.schema)
        if k < blocks - 1:
            result = materialize(result, "hits")
    return result.select(*keep, *names)


def _matcher(docs: DataFrame, index: tuple[list[str], list[WindowIndex]], text_col: str, names: list[str]):
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def match(batches):
        items, tables = shared.value
        for batch in w.small_batches(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col))
            hashes, at = w.word_hashes(texts, w.ALPHANUMERIC)
            change, pairs = np.zeros(len(hashes) + 1, np.int64), []
            earlier = [batch.column(batch.schema.get_field_index(x)).to_pylist() for x in names[1:]]
            for k, (starts, ends) in enumerate(zip(*earlier[:2], strict=True)):
                if starts:
                    np.add.at(change, at[k] + np.array(starts), 1)
                    np.add.at(change, at[k] + np.array(ends), -1)
            for table in tables:
                for start, window in table.occurrences(hashes, at):
                    np.add.at(change, start, 1)
                    np.add.at(change, start + table.length[window], -1)
                    text = np.searchsorted(at, start, "right") - 1
                    pairs.append(np.unique(text * len(items) + table.item[window]))
            hit = np.cumsum(change)[:-1] > 0
            edge = np.zeros(len(hit) + 1, bool)
            edge[at] = True
            from_ = np.flatnonzero(hit & (edge[:-1] | ~np.r_[False, hit[:-1]])) if len(hit) else np.empty(0, int)
            to = np.flatnonzero(hit & (edge[1:] | ~np.r_[hit[1:], False])) + 1 if len(hit) else np.empty(0, int)
            text = np.searchsorted(at, from_, "right") - 1
            runs = np.searchsorted(from_, at).astype(np.int32)
            found: list[set[str]] = [set(x or ()) for x in earlier[2]]
            for pair in np.unique(np.concatenate(pairs)) if pairs else ():
                found[pair // len(items)].add(items[pair % len(items)])
            own = {
                names[0]: pa.array(np.diff(at), pa.int64()),
                names[1]: pa.ListArray.from_arrays(runs, (from_ - at[text]).astype(np.int32)),
                names[2]: pa.ListArray.from_arrays(runs, (to - at[text]).astype(np.int32)),
                names[3]: pa.array([sorted(x) for x in found], pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays([own.get(n, batch.column(k)) for k, n in enumerate(batch.schema.names)], batch.schema.names)

    return match


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each document row."""
    found = find_items(docs.select("doc_id", "text"), items, keep=["doc_id"], **options)
    n_hit = F.aggregate(F.zip_with("hit_to", "hit_from", lambda e, s: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("item_ids")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents without those that hold a window of an item; columns and texts as they were."""
    found = find_items(docs, items, **options)
    return found.where(F.size(F.col(found.columns[-1])) == 0).select(*docs.columns)
