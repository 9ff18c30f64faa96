"""Context-tree weighting over bytes: how many digits it takes to code a text.

A byte is eight binary decisions, each with a context: the decisions before it in its byte (``node``, 1 to 255) and
the ``DEPTH`` bytes before. In every context of every depth, counts of zeros and ones give a Krichevsky-Trofimov
estimate. A context's weighted probability is the even mix of its own estimate and the product of its children's
(the contexts one byte longer), so a tree of all depths is mixed. The learnt texts fix all counts, and a further
decision has the probability that the mix gives to it after them: along the path from the empty context down, each
depth's estimate weighs as much as the learnt texts say that the tree ends there.

A text is its UTF-8 bytes with A-Z in lower case, then one end byte 0xFF, which no UTF-8 text holds; before its
first byte stand ``DEPTH`` end bytes. So probabilities of all texts sum to one at most.

The base is the log probability of the words (and one end a text) under add-one counts of words.

How it runs: each task counts the different byte runs and words of slices of about ``SLICE_BYTES`` of text and writes
(slice, key, count) rows beside the packed texts. Counts are summed by key; the tree is built bottom-up and read
top-down as one grouped sum and one join a depth, where no key has more than 256 rows. Values then go back to the slices
by key, and each slice meets its own texts and values in one task. Nothing of the corpus goes to the driver but three sums,
nothing is broadcast, and no key has more rows than there are slices.

Defined results:

- Null and empty texts have one token, the end, and the probability of an end at the start of a text.
- Very long texts are whole; windows of ``WINDOW`` positions bound what is derived at once, and a slice holds at least one text.
- Repeated rows count each time they stand in the table; a null id learns like any other unless the caller's ``learn`` says no.
- With nothing to learn from, each decision has probability one half and the base is 0.
- An empty table gives an empty result. Only the named columns are read, whatever the others are called.
- There are no ties: sums may differ in the last bits between runs.

Words are told apart by 63 bits of a hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm import words as W
from caseflow.llm.language import fold
from caseflow.llm.tables import materialize

DEPTH = 4
END = 0xFF
SLICE_BYTES = 32 << 20
PACK_BYTES = 2 << 20
WINDOW = 1 << 19
#: New keys of a slice are merged when there are so many.
PENDING = 1 << 19
ROWS = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] = _LOWER[97:123]


def _padded(data: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``depth`` end bytes before and one after, and where each starts (one entry more than texts)."""
    sizes = np.diff(at)
    starts = np.concatenate([[0], np.cumsum(sizes + depth + 1)])
    flat = np.full(int(starts[-1]), END, np.uint8)
    for first in range(0, len(data), WINDOW):
        place = np.arange(first, min(first + WINDOW, len(data)))
        whose = np.searchsorted(at, place, "right") - 1
        flat[place + depth + whose * (depth + 1)] = data[place]
    return flat, starts


def _windows(flat: np.ndarray, starts: np.ndarray, depth: int):
    """``whose, runs``: for windows of positions, the text and the run of depth + 1 bytes that ends at each byte to code."""
    for first in range(0, len(flat), WINDOW):
        last = min(first + WINDOW, len(flat))
        low = max(0, first - depth)
        piece = flat[low:last].astype(np.int64)
        runs = np.zeros(last - first, np.int64)
        for k in range(depth + 1):  # the byte k places before, zero where the table of texts begins
            moved = piece[max(0, first - low - k) : len(piece) - k]
            runs[len(runs) - len(moved) :] += moved << (8 * k)
        place = np.arange(first, last)
        whose = np.searchsorted(starts, place, "right") - 1
        coded = place - starts[whose] >= depth
        yield whose[coded], runs[coded]


def _word_keys(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Negative keys of all words, and where each text's words start."""
    column = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))
    hashes, starts = W.word_hashes(column, W.NON_SPACE)
    return -1 - (hashes >> np.uint64(1)).astype(np.int64), starts


class _Counts:
    """Different keys of a slice with their learnt counts, in order; what came since the last merge is kept apart."""

    def __init__(self):
        self.keys, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.fresh, self.held = [], 0

    def add(self, keys: np.ndarray, learnt: np.ndarray) -> None:
        for chosen, weight in ((keys[learnt], 1), (keys[~learnt], 0)):
            if len(chosen):
                found, n = np.unique(chosen, return_counts=True)
                self.fresh.append((found, n * weight))
                self.held += len(found)
        if self.held > PENDING:
            self._merge()

    def _merge(self) -> None:
        """What is new goes to its place between the keys so far, which are copied once and never sorted again."""
        keys, counts = (np.concatenate(x) for x in zip(*self.fresh))
        self.fresh, self.held = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, counts = keys[first], np.add.reduceat(counts, first)
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        self.counts[at[known]] += counts[known]
        at, keys, counts = at[~known], keys[~known], counts[~known]
        self.keys, self.counts = np.insert(self.keys, at, keys), np.insert(self.counts, at, counts)

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        if self.fresh:
            self._merge()
        return self.keys, self.counts


def _gather(docs: DataFrame, depth: int) -> DataFrame:
    """Rows of packed texts (``blob`` not null) and rows of a slice's keys, from ``id, text, learn``."""
    id_type = docs.schema["id"].dataType
    schema = T.StructType([
        T.StructField("slice", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), T.StructField("learn", T.ArrayType(T.BooleanType())),
        T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("blob", T.BinaryType()), T.StructField("key", T.LongType()), T.StructField("n", T.LongType()),
    ])

    def gather(batches):
        names = [f.name for f in schema]
        W.give_back()
        number, held, counts, arrow = TaskContext.get().partitionId() << 32, 0, _Counts(), None

        def key_rows():
            keys, n = counts.total()
            for k in range(0, len(keys), ROWS):
                own = pa.array(keys[k : k + ROWS])
                empty = [pa.nulls(len(own), t) for t in arrow]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), number)), *empty, own, pa.array(n[k : k + ROWS])], names)

        for batch in W.small_batches(batches, "text", PACK_BYTES):
            data, at = W.text_bytes(batch.column(1))
            data = _LOWER[data]
            learnt = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            flat, starts = _padded(data, at, depth)
            for whose, runs in _windows(flat, starts, depth):
                counts.add(runs, learnt[whose])
            keys, first = _word_keys(data, at)
            counts.add(keys, np.repeat(learnt, np.diff(first)))
            arrow = [pa.list_(batch.schema.field(0).type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary()]
            blob = pa.compress(data.tobytes(), codec="zstd", asbytes=True)
            whole = pa.array([0, batch.num_rows], pa.int32())
            packed = [
                pa.ListArray.from_arrays(whole, batch.column(0)), pa.ListArray.from_arrays(whole, batch.column(2)),
                pa.array([np.diff(at)], pa.list_(pa.int64())), pa.array([blob], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([number]), *packed, pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64())], names)
            held += len(data)
            if held >= SLICE_BYTES:
                yield from key_rows()
                number, held, counts = number + 1, 0, _Counts()
                W.give_back()
        if arrow:
            yield from key_rows()
        counts = batch = data = flat = None
        W.give_back()

    return docs.mapInArrow(gather, schema)


def _log_gamma(x: Column) -> Column:
    """Stirling's series nine places further on, where it is exact to twelve digits, for x of one half or more."""
    y = x + 9
    down = F.lit(1.0)
    for k in range(9):
        down = down * (x + k)
    series = 1 / (12 * y) - 1 / (360 * F.pow(y, F.lit(3))) + 1 / (1260 * F.pow(y, F.lit(5))) - 1 / (1680 * F.pow(y, F.lit(7)))
    return (y - 0.5) * F.ln(y) - y + 0.5 * np.log(2 * np.pi) + series - F.ln(down)


def _log_estimate(zeros: Column, ones: Column) -> Column:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones in any order."""
    both = _log_gamma(zeros + F.lit(0.5)) + _log_gamma(ones + F.lit(0.5)) - _log_gamma(zeros + ones + F.lit(1.0)) - float(np.log(np.pi))
    return F.when((zeros == 0) & (ones == 0), F.lit(0.0)).otherwise(both)


def _log_mix(a: Column, b: Column) -> Column:
    """Log of the mean of exp(a) and exp(b)."""
    return F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b))) - float(np.log(2))


def _context(column: Column, depth: int) -> Column:
    """The last ``depth`` bytes of a context."""
    return column.bitwiseAND(F.lit((1 << (8 * depth)) - 1))


def _decisions(runs: DataFrame) -> DataFrame:
    """``key, n, context, node, bit``: the eight decisions of each run's last byte."""
    byte = "cast(key & 255 AS int)"
    rows = runs.select("key", "n", F.shiftright("key", 8).alias("context"), F.explode(F.sequence(F.lit(0), F.lit(7))).alias("at"))
    return rows.select(
        "key", "n", "context", F.expr(f"shiftleft(1, at) | shiftright({byte}, 8 - at)").alias("node"),
        F.expr(f"shiftright({byte}, 7 - at) & 1").alias("bit"),
    )


def _levels(decisions: DataFrame, depth: int) -> list[DataFrame]:
    """By depth: ``context, node, zeros, ones`` with the log estimate ``own`` and the log weighted probability ``mixed``."""
    counts = [F.sum(F.expr("if(bit = 0, n, 0)")).alias("zeros"), F.sum(F.expr("if(bit = 1, n, 0)")).alias("ones")]
    level = decisions.groupBy("context", "node").agg(*counts).withColumn("own", _log_estimate(F.col("zeros"), F.col("ones")))
    levels = [materialize(level.withColumn("mixed", F.col("own")), "contexts")]
    for d in range(depth - 1, -1, -1):
        sums = [F.sum(c).alias(c) for c in ("zeros", "ones", "mixed")]
        level = levels[0].groupBy(_context(F.col("context"), d).alias("context"), "node").agg(*sums)
        level = level.withColumn("own", _log_estimate(F.col("zeros"), F.col("ones")))
        levels.insert(0, materialize(level.withColumn("mixed", _log_mix(F.col("own"), F.col("mixed"))), "contexts"))
    return levels


def _read(levels: list[DataFrame], depth: int) -> DataFrame:
    """``context, node, p0, p1``: probabilities of a zero and a one in each context of the full depth."""
    total = F.col("zeros") + F.col("ones") + 1
    stop = F.exp(F.col("own") - F.col("mixed") - float(np.log(2))) if depth else F.lit(1.0)
    down = levels[0].select(
        "context", "node", (stop * (F.col("zeros") + 0.5) / total).alias("p0"), (stop * (F.col("ones") + 0.5) / total).alias("p1"), (1 - stop).alias("left")
    )
    for d in range(1, depth + 1):
        stop = F.exp(F.col("own") - F.col("mixed") - float(np.log(2))) if d < depth else F.lit(1.0)
        own = levels[d].select(
            "context", "node", _context(F.col("context"), d - 1).alias("parent"), stop.alias("stop"),
            ((F.col("zeros") + 0.5) / total).alias("e0"), ((F.col("ones") + 0.5) / total).alias("e1"),
        )
        above = down.withColumnRenamed("context", "parent")
        down = own.join(above, ["parent", "node"]).select(
            "context", "node", (F.col("p0") + F.col("left") * F.col("stop") * F.col("e0")).alias("p0"),
            (F.col("p1") + F.col("left") * F.col("stop") * F.col("e1")).alias("p1"), (F.col("left") * (1 - F.col("stop"))).alias("left"),
        )
    return down.drop("left")


def run_values(runs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``key, value``: log10 of the probability of each run's last byte after the others, from ``key, n``.

    A key holds depth + 1 bytes, the last one lowest; ``n`` is how often the learnt texts hold the run, 0 included.
    """
    decisions = _decisions(runs)
    down = _read(_levels(decisions, depth), depth)
    told = decisions.join(down, ["context", "node"])
    return told.groupBy("key").agg((F.sum(F.ln(F.expr("if(bit = 0, p0, p1)"))) / float(np.log(10))).alias("value"))


def _score(packs: DataFrame, values: DataFrame, tokens: int, kinds: int, ends: int, depth: int) -> DataFrame:
    """``id, learnt, n_tokens, n_known, base_score, n_bytes, score`` of every packed text."""
    id_type = packs.schema["ids"].dataType.elementType
    parts = [("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("n_bytes", T.LongType()), ("score", T.DoubleType())]
    schema = T.StructType([T.StructField("id", id_type), T.StructField("learnt", T.BooleanType()), *(T.StructField(c, t) for c, t in parts)])
    space = tokens + ends + kinds + (1 if ends else 0) + 1

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        W.give_back()
        keys, out = right.column("key").to_numpy(), []
        order = np.argsort(keys)
        keys, own = keys[order], right.column("value").to_numpy()[order]
        del order
        for k in range(left.num_rows):
            ids, learnt, sizes = (left.column(c)[k].values for c in ("ids", "learn", "sizes"))
            sizes = sizes.to_numpy()
            at, n = np.concatenate([[0], np.cumsum(sizes)]), len(sizes)
            raw = pa.decompress(left.column("blob")[k].as_buffer(), int(at[-1]), codec="zstd") if at[-1] else b""
            data = np.frombuffer(raw, np.uint8)
            total = np.zeros(n)
            for whose, runs in _windows(*_padded(data, at, depth), depth):
                total += np.bincount(whose, own[np.searchsorted(keys, runs)], n)
            found, first = _word_keys(data, at)
            count, whose = own[np.searchsorted(keys, found)], np.repeat(np.arange(n), np.diff(first))
            base = np.bincount(whose, np.log10((count + 1) / space), n) + np.log10((ends + 1) / space)
            known = np.bincount(whose, count > 0, n).astype(np.int64) + (1 if ends else 0)
            columns = [ids, learnt, pa.array(np.diff(first) + 1), pa.array(known), pa.array(base), pa.array(sizes), pa.array(total)]
            out.append(pa.RecordBatch.from_arrays(columns, [f.name for f in schema]))
        return pa.Table.from_batches(out)

    return packs.groupBy("slice").cogroup(values.groupBy("home")).applyInArrow(score, schema)


def score_texts(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> tuple[DataFrame, int]:
    """Scores of all texts by a model of those where ``learn`` holds, and the number of learnt tokens.

    Columns: ``id, learnt, n_tokens, n_known, base_score, n_bytes, score``, both scores as log10. The code length per byte is
    ``-score * log2(10) / (n_bytes + 1)``. ``depth`` is 0 to 6.
    """
    if not 0 <= depth <= 6:
        raise ValueError("a run of depth + 1 bytes must fit 56 bits")
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    gathered = materialize(_gather(source, depth), "gathered")
    packs = gathered.where("blob IS NOT NULL").select("slice", "ids", "learn", "sizes", "blob")
    pairs = gathered.where("blob IS NULL").select("slice", "key", "n")
    counts = materialize(pairs.groupBy("key").agg(F.sum("n").alias("n")), "counts")
    found = counts.where("key < 0").agg(F.sum("n"), F.sum((F.col("n") > 0).cast("long"))).first()
    words, kinds = found[0] or 0, found[1] or 0
    ends = packs.select(F.sum(F.size(F.filter("learn", lambda x: x)))).first()[0] or 0
    values = run_values(counts.where("key >= 0"), depth)
    values = values.unionByName(counts.where("key < 0").select("key", F.col("n").cast("double").alias("value")))
    values = materialize(values, "values")
    back = pairs.select(F.col("slice").alias("home"), "key").join(values, "key").select("home", "key", "value")
    return _score(packs, back, words, kinds, ends, depth), words + ends


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; learns from the rows outside fold 2 of 7.

    A null id counts as the empty string, which is learnt from.
    """
    held_out = F.coalesce(fold(7) == 2, F.lit(False))
    scored, tokens = score_texts(docs, ~held_out)
    return scored.select(
        F.col("id").alias("doc_id"), (~F.col("learnt")).alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        F.round("base_score", 6).alias("base_score"), F.round("score", 4).alias("score"),
    )
