"""Vector codes by product quantisation, with Orchard search for the nearest codebook entry.

Components become whole numbers, vectors are cut into parts, and each part position has a codebook that a few
rounds of means improve. All arithmetic is on whole numbers, so results do not depend on the order of rows,
on partitions, or on a task that ran twice.

Orchard search keeps for every entry the list of the other entries by distance. A part starts at entry 0 and
walks the current entry's list; a nearer entry becomes current and its list is walked from the start; entries
seen before are passed over by their marks. The walk ends where the list's entry is further from the current
one than twice the part's distance to it: by the triangle inequality nothing beyond can be as near. The bound is
strict, so that entries at the same distance are still met and the lower index wins.

Defined results:

- Rows whose vector is null or holds null or non-finite components are dropped, and so are rows whose vector has
  another length than that of the smallest kept id: they cannot be compared.
- A length that is no multiple of ``parts`` gives parts that differ by one component; an empty vector has code 0.
- Components beyond ``LARGEST`` in size after scaling are taken as ``LARGEST``, so that distances fit 64 bits.
- Null ids come last among the first entries, equal ids are ordered by their vectors, repeated rows count each time.
- With fewer rows than entries, codebooks are shorter. An empty table gives an empty result.
- Only the named columns are read; others, whatever their names, do not matter. There is no text to be long.

A round is one pass of the table. A task returns a number per entry and position, so what is shuffled and
collected has the size of the codebooks. They are sent to the tasks with the code; nothing else is broadcast but
the sums of at most ``HOT_LABELS`` labels.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.tables import materialize

LARGEST = 1 << 25
#: Labels with more than one row in so many are joined by broadcast; there cannot be more of them than this.
HOT_LABELS = 1024
LONG_MAX = (1 << 63) - 1


def _bounds(dim: int, parts: int) -> list[int]:
    return [k * dim // parts for k in range(parts + 1)]


def _whole(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """Rows of whole components from a list column whose lists all have ``dim`` elements."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = pc.list_flatten(column).cast(pa.float64()).to_numpy(zero_copy_only=False)
    whole = np.clip(np.floor(values * scale), -LARGEST, LARGEST)
    return whole.astype(np.int64).reshape(len(column), dim)


class Orchard:
    """Distance-sorted neighbour lists of a codebook's entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.gaps = ((entries[:, None] - entries[None]) ** 2).sum(axis=2)
        self.lists = np.argsort(self.gaps, axis=1, kind="stable")

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each row's nearest entry (the lowest of equals) and the squared distance."""
        n, k = len(rows), len(self.entries)
        best, place = np.zeros(n, np.int64), np.zeros(n, np.int64)
        distance = ((rows - self.entries[0]) ** 2).sum(axis=1)
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        walking = np.arange(n)
        while len(walking):
            entry = self.lists[best[walking], place[walking]]
            near = self.gaps[best[walking], entry] <= 4 * distance[walking]
            walking, entry = walking[near], entry[near]
            place[walking] += 1
            new = ~seen[walking, entry]
            who, entry = walking[new], entry[new]
            seen[who, entry] = True
            found = ((rows[who] - self.entries[entry]) ** 2).sum(axis=1)
            better = (found < distance[who]) | ((found == distance[who]) & (entry < best[who]))
            jumped = who[better]
            best[jumped], distance[jumped], place[jumped] = entry[better], found[better], 0
            walking = walking[place[walking] < k]
        return best, distance


class Codebooks:
    """Entries by part: a list of arrays with a row for each entry."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books

    def digest(self) -> str:
        numbers = ",".join(str(v) for book in self.books for v in book.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()


def _kept(df: DataFrame, id_col: str, vector_col: str, label_col: str | None) -> DataFrame:
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    rows = df.select(F.col(id_col).alias("id"), label.alias("label"), F.col(vector_col).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vector").isNotNull() & finite)


def fit(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = 8, entries: int = 16,
    rounds: int = 6, scale: int = 4096,
) -> Codebooks | None:
    """Codebooks that start from the ``entries`` smallest ids; None where no row is kept."""
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    kept = _kept(df, id_col, vector_col, None).select("id", "vector")
    first = kept.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return None
    dim = len(first[0]["vector"])
    first = kept.where(F.size("vector") == dim).orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).collect()
    start = _whole(pa.array([r["vector"] for r in first], pa.list_(pa.float64())), dim, scale)
    cuts = _bounds(dim, parts)
    books = [start[:, a:b].copy() for a, b in zip(cuts, cuts[1:])]
    vectors = kept.where(F.size("vector") == dim).select("vector")
    for _ in range(rounds):
        sums = _sums(vectors, books, cuts, scale).collect()
        count = {(r["part"], r["entry"]): r["n"] for r in sums if r["place"] < 0}
        for r in sums:
            if r["place"] >= 0:
                books[r["part"]][r["entry"], r["place"]] = r["total"] // count[r["part"], r["entry"]]
    return Codebooks(books)


def _sums(vectors: DataFrame, books: list[np.ndarray], cuts: list[int], scale: int) -> DataFrame:
    """Sums by part, entry and position of the parts assigned to each used entry; place -1 has their number."""

    def add(batches):
        searches = [Orchard(b) for b in books]
        count = [np.zeros(len(b), np.int64) for b in books]
        total = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            rows = _whole(batch.column(0), cuts[-1], scale)
            for p, search in enumerate(searches):
                part = rows[:, cuts[p] : cuts[p + 1]]
                code, _ = search.nearest(part)
                count[p] += np.bincount(code, minlength=len(books[p]))
                np.add.at(total[p], code, part)
        out = []
        for p in range(len(books)):
            for e in np.flatnonzero(count[p]).tolist():
                out.append((p, e, -1, int(count[p][e]), 0))
                out.extend((p, e, k, 0, int(v)) for k, v in enumerate(total[p][e]))
        names = ["part", "entry", "place", "n", "total"]
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)

    partial = vectors.mapInArrow(add, "part int, entry int, place int, n long, total long")
    return partial.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def encode(
    df: DataFrame, books: Codebooks, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str | None = "label", scale: int = 4096,
) -> DataFrame:
    """``id, label, code, error`` of every kept row: two hex digits for each part, and the squared distances' sum."""
    dim = sum(b.shape[1] for b in books.books)
    cuts = np.cumsum([0, *(b.shape[1] for b in books.books)]).tolist()
    kept = _kept(df, id_col, vector_col, label_col).where(F.size("vector") == dim)
    entries = books.books
    schema = T.StructType([*kept.select("id", "label").schema, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    digits = np.array([f"{k:02x}" for k in range(256)])

    def tell(batches):
        searches = [Orchard(b) for b in entries]
        for batch in batches:
            rows = _whole(batch.column(2), dim, scale)
            error, codes = np.zeros(batch.num_rows, np.int64), []
            for p, search in enumerate(searches):
                code, distance = search.nearest(rows[:, cuts[p] : cuts[p + 1]])
                error += distance
                codes.append(digits[code])
            text = pc.binary_join_element_wise(*(pa.array(c, pa.string()) for c in codes), "")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text, pa.array(error)], ["id", "label", "code", "error"])

    return kept.mapInArrow(tell, schema)


def with_label_error(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors' sum over equal labels, nulls together. Sums beyond 64 bits are the largest long.

    Sums of hot labels, of which there is a fixed number at most, are broadcast; the rest is joined by label.
    """
    coded = materialize(coded, "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label").agg(F.count("*").alias("n"), F.least(total, F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long").alias("label_error"))
    sums = materialize(sums.withColumnRenamed("label", "of"), "label_sums")
    rows = coded.count()
    hot = sums.where(F.col("n") * HOT_LABELS > rows).drop("n").withColumn("is_hot", F.lit(True))
    marked = coded.join(F.broadcast(hot), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    cold = marked.where("is_hot IS NULL").drop("label_error", "is_hot")
    rest = sums.where(F.col("n") * HOT_LABELS <= rows).drop("n")
    cold = cold.join(rest, F.col("label").eqNullSafe(F.col("of"))).drop("of")
    return marked.where("is_hot").drop("is_hot").unionByName(cold)


def report(df: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every kept row."""
    books = fit(df)
    if books is None:
        return df.sparkSession.createDataFrame(
            [], T.StructType([df.select("vec_id").schema[0], *(T.StructField(c, t) for c, t in (
                ("code", T.StringType()), ("error", T.LongType()), ("label_error", T.LongType()), ("codebooks_sha256", T.StringType())))])
        )
    coded = with_label_error(encode(df, books))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
