"""Token ids in packed rows: best-fit-decreasing packing with a segment tree over free capacities.

Each text becomes token ids. A document longer than a row is cut into pieces of one row's length and a rest, so that
no token is lost. Pieces are packed longest first; each goes into the open row with the least free room that still
holds it, which a segment tree over the capacities 0..length finds in log(length) steps.

Packing works on groups of about ``group_tokens`` tokens inside a task, so memory has that bound whatever the input.
A row of the result is one row of an id matrix: ``ids`` holds ``length`` little-endian numbers of 2 bytes (4 if the
vocabulary needs them), filled up with ``pad_id``; ``cu_seqlens`` are the cumulative segment lengths; at each of
``position_resets`` positions start again from 0; ``doc_ids``, ``doc_rows`` and ``piece_starts`` say which document
each segment comes from, which row of the input that was, and at which of its tokens the segment begins.

Defined results. Null and empty texts have no tokens and are in no row. Null ids stay null in ``doc_ids``. Equal rows
are packed as often as they stand there, under ``doc_rows`` of their own. Sizes tie by the order of the input.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.words import small_batches

#: Fixed value: how the byte-level vocabularies split text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SCHEMA = (
    "shard long, row int, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, "
    "doc_ids array<long>, doc_rows array<long>, piece_starts array<long>"
)


class CapacityTree:
    """Open rows by free capacity; ``best`` gives the one with the least room that is enough."""

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        node = self.leaves + capacity
        while node:
            self.count[node] += 1
            node >>= 1

    def best(self, size: int) -> tuple[int, int] | None:
        """``capacity, row`` of the smallest capacity of at least ``size``; the row is taken out."""
        node = self.leaves + size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1  # up until a right neighbour has rows
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        row = self.rows[capacity].pop()
        while node:
            self.count[node] -= 1
            node >>= 1
        return capacity, row


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows as lists of piece numbers, in the order in which pieces were put there."""
    tree, rows = CapacityTree(length), []
    for piece in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        found = tree.best(sizes[piece])
        if found is None:
            rows.append([])
            found = length, len(rows) - 1
        capacity, row = found
        rows[row].append(piece)
        if capacity > sizes[piece]:
            tree.add(capacity - sizes[piece], row)
    return rows


def read_ranks(spark, path: str) -> dict[bytes, int]:
    """A vocabulary file of lines "base64 rank", through Spark, so that any store will do."""
    content = spark.read.format("binaryFile").load(path).select("content").first()[0]
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, bytes(content).splitlines())}


def pack(
    docs: DataFrame, vocabulary: str, length: int = 2048, pad_id: int = 0, group_tokens: int = 2_000_000,
    id_col: str = "doc_id", text_col: str = "text", pattern: str = PATTERN,
) -> DataFrame:
    """The packed rows (see SCHEMA). ``vocabulary`` is the path of a tokenizer's rank file."""
    ranks = read_ranks(docs.sparkSession, vocabulary)
    kind = np.dtype("<u2") if max([pad_id, *ranks.values()]) < 65536 else np.dtype("<u4")
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def rows_of(pieces, shard):
        packed = best_fit_decreasing([len(p[0]) for p in pieces], length)
        out = {name: [] for name in ("n", "ids", "cu", "resets", "docs", "rows", "starts")}
        for row in packed:
            ids = np.full(length, pad_id, kind)
            ends = np.cumsum([len(pieces[k][0]) for k in row]).astype(np.int32)
            begins = np.r_[0, ends[:-1]].astype(np.int32)
            for k, s, e in zip(row, begins, ends, strict=True):
                ids[s:e] = pieces[k][0]
            out["n"].append(int(ends[-1]))
            out["ids"].append(ids.tobytes())
            out["cu"].append(np.r_[0, ends].astype(np.int32))
            out["resets"].append(begins)
            for name, at in (("docs", 1), ("rows", 2), ("starts", 3)):
                out[name].append([pieces[k][at] for k in row])
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(packed), shard, np.int64)), pa.array(np.arange(len(packed), dtype=np.int32)),
                pa.array(out["n"], pa.int32()), pa.array(out["ids"], pa.binary()), pa.array(out["cu"], ints), pa.array(out["resets"], ints),
                pa.array(out["docs"], longs), pa.array(out["rows"], longs), pa.array(out["starts"], longs),
            ],
            [x.split()[0] for x in SCHEMA.split(", ")],
        )

    def tokenize(batches):
        import tiktoken

        encoding = tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
        part, group, number, held, pieces = TaskContext.get().partitionId(), 0, 0, 0, []
        for batch in small_batches(batches, "text"):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoding.encode_to_numpy(text.as_py() or "", disallowed_special=()).astype(kind)
                for start in range(0, len(ids), length):
                    pieces.append((ids[start : start + length], doc_id, (part << 33) + number, start))
                    held += len(pieces[-1][0])
                    if held >= group_tokens:
                        yield rows_of(pieces, (part << 33) + group)
                        group, held, pieces = group + 1, 0, []
                number += 1
        if pieces:
            yield rows_of(pieces, (part << 33) + group)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).alias("text")).mapInArrow(tokenize, SCHEMA)


def write(packed: DataFrame, path: str) -> None:
    """The id matrices with their lengths and resets as Parquet files; a shard's rows stand together in order."""
    packed.write.parquet(path)


def position_ids(cu_seqlens: list[int], length: int) -> np.ndarray:
    """Positions within a row: from 0 in each segment, and 0 in the padding."""
    result = np.zeros(length, np.int64)
    for start, end in zip(cu_seqlens[:-1], cu_seqlens[1:], strict=True):
        result[start:end] = np.arange(end - start)
    return result


def unpack(packed: DataFrame, length: int = 2048) -> DataFrame:
    """``doc_row, doc_id, pieces``: each document's pieces of ids (hex, in order), for reading back what was packed."""
    segment = F.explode(F.arrays_zip("doc_ids", "doc_rows", "piece_starts", "position_resets", F.expr("slice(cu_seqlens, 2, size(cu_seqlens) - 1)").alias("ends")))
    width = F.length("ids") / F.lit(length)
    rows = packed.select(segment.alias("s"), F.col("ids"), width.cast("int").alias("w")).select(
        F.col("s.doc_rows").alias("doc_row"), F.col("s.doc_ids").alias("doc_id"), F.col("s.piece_starts").alias("start"),
        F.hex(F.expr("substring(ids, s.position_resets * w + 1, (s.ends - s.position_resets) * w)")).alias("ids"),
    )
    pieces = F.array_sort(F.collect_list(F.struct("start", "ids")))
    return rows.groupBy("doc_row", "doc_id").agg(F.transform(pieces, lambda p: p["ids"]).alias("pieces"))
