"""Toxicity: class-conditional Kneser-Ney models of letters in words.

A word is a run of letters and digits, lower-cased. Each class (toxic, ordinary) has an n-gram model over the letters of
its words, so that a rare form shares the evidence of its stem. At the highest order the classes have counts of their own
with absolute discounting; what the discount frees goes to one backoff model that both share, built from continuation
counts (in how many contexts a shorter n-gram was seen) down to single letters. An n-gram that neither class has seen
therefore says nothing but what its context's backoff weights say.

A text's log-likelihood ratio is normalised by its length in two ways: per word over the whole text, and per word over the
run of ``window`` words where it is largest, as a long text may be toxic in one place (there, a repeated word counts
once). A logistic fit turns both into
the score. It uses a sample of at most about ``calibration_rows`` labelled rows, each scored by a model of the other half
of the labelled rows; counts always come from all labelled rows.

Every n-gram and every context counts, however rare. The model is cut by hash of the contexts into blocks of about
``block_grams`` n-grams. A task holds one block at a time and takes the words of a slice of texts through all of them.

Defined results. Empty and null texts get the score of a text without evidence. Labels other than 0 and 1, null labels
and null ids are not learnt from; several labels of one id count as toxic if one of them is. Without rows of both classes
all scores are 0. Repeated rows count as often as they occur.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.language import fold
from caseflow.llm.tables import distinct_name, likely_rows, materialize
from caseflow.llm.words import mix, small_batches

ORDER = 5
DISCOUNT = 0.75
WINDOW = 5
BLOCK_GRAMS = 1 << 22
CALIBRATION_ROWS = 20_000
SLICE = 1 << 20
#: With several blocks, slices are up to so many times larger, as every slice reads every block.
MOST_SLICES = 8
KNOWN_WORDS = 300_000
WORD = re.compile(r"[^\W_]+")
#: Stands before a word, and behind it.
EDGE = "\x00"


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def gram_counts(labelled: DataFrame, order: int) -> DataFrame:
    """``gram, half, toxic, ordinary``: counts of n-grams in all rows of ``text, toxic, half``."""

    def grams(counts: Counter):
        total: dict[tuple[str, int], list[int]] = {}
        for (word, half, toxic), n in counts.items():
            padded = EDGE * (order - 1) + word + EDGE
            for k in range(len(word) + 1):
                total.setdefault((padded[k : k + order], half), [0, 0])[toxic] += n
        rows = list(total.items())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([g for (g, _), _ in rows], pa.string()), pa.array([h for (_, h), _ in rows], pa.int32()),
                pa.array([c[1] for _, c in rows], pa.int64()), pa.array([c[0] for _, c in rows], pa.int64()),
            ],
            ["gram", "half", "toxic", "ordinary"],
        )

    def count(batches):
        counts: Counter = Counter()
        for batch in small_batches(batches, "text", SLICE):
            for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for word, n in Counter(words_of(text)).items():
                    counts[word, half, toxic] += n
            if len(counts) > KNOWN_WORDS:
                yield grams(counts)
                counts = Counter()
        if counts:
            yield grams(counts)

    found = labelled.select("text", "toxic", "half").mapInArrow(count, "gram string, half int, toxic long, ordinary long")
    return found.groupBy("gram", "half").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _with_context(grams: DataFrame, n: str, low: DataFrame | None, floor: Column) -> DataFrame:
    """``gram, p``: interpolated probability of a gram's last letter, from counts ``n`` and the model one order below."""
    head = F.expr("substring(gram, 1, length(gram) - 1)")
    contexts = grams.groupBy(head.alias("head")).agg(F.sum(n).alias("s"), F.count("*").alias("kinds"))
    joined = grams.withColumn("head", head).join(contexts, "head")
    if low is None:
        joined = joined.withColumn("below", floor)
    else:
        joined = joined.withColumn("tail", F.expr("substring(gram, 2)")).join(low.select(F.col("gram").alias("tail"), F.col("p").alias("below")), "tail")
    p = (F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("kinds") * F.col("below")) / F.col("s")
    return joined.select("gram", p.alias("p"))


def shared_backoff(grams: DataFrame, order: int) -> DataFrame:
    """``gram, p`` for all n-grams one letter shorter than ``grams``, from continuation counts of both classes."""
    levels = [grams.select("gram").distinct()]
    for _ in range(order - 1):
        levels.append(materialize(levels[-1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n")), "grams"))
    low = None
    for level in reversed(levels[1:]):
        letters = None if low is not None else level.count()
        low = materialize(_with_context(level, "n", low, F.lit(1.0 / max(1, letters or 1))), "backoff")
    return low


def _class_model(counts: DataFrame, backoff: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``head, gram, value`` and ``head, value``: log ratios of n-grams, and of contexts whose next letter is unseen."""
    pooled = counts.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))
    pooled = materialize(pooled, "grams")
    head = F.expr("substring(gram, 1, length(gram) - 1)")
    per_class = [
        x
        for c in ("toxic", "ordinary")
        for x in (F.sum(c).alias(f"s_{c}"), F.sum((F.col(c) > 0).cast("long")).alias(f"k_{c}"))
    ]
    heads = materialize(pooled.groupBy(head.alias("head")).agg(*per_class), "heads")
    joined = pooled.withColumn("head", head).withColumn("tail", F.expr("substring(gram, 2)")).join(heads, "head")
    joined = joined.join(backoff.select(F.col("gram").alias("tail"), F.col("p").alias("below")), "tail")

    def chance(c: str) -> Column:
        own = (F.greatest(F.col(c) - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(f"k_{c}") * F.col("below")) / F.col(f"s_{c}")
        return F.when(F.col(f"s_{c}") > 0, own).otherwise(F.col("below"))

    def weight(c: str) -> Column:
        return F.when(F.col(f"s_{c}") > 0, DISCOUNT * F.col(f"k_{c}") / F.col(f"s_{c}")).otherwise(1.0)

    grams = joined.select("head", "gram", F.log(chance("toxic") / chance("ordinary")).alias("value"))
    return grams, heads.select("head", F.log(weight("toxic") / weight("ordinary")).alias("value"))


def _keys(grams: list[str], length: int) -> np.ndarray:
    codes = np.frombuffer("".join(grams).encode("utf-32-le", "replace"), np.uint32).reshape(-1, length)
    return _key(codes)


def _key(codes: np.ndarray) -> np.ndarray:
    key = np.zeros(len(codes), np.uint64)
    for k in range(codes.shape[1]):
        key = mix(key + codes[:, k].astype(np.uint64) + np.uint64(k + 1))
    return key


class WordScores:
    """Log-likelihood ratios of words; what was looked up is kept for a while."""

    def __init__(self, blocks: list, order: int):
        self.blocks, self.order, self.known = blocks, order, {}

    def _tables(self):
        """The blocks in turn. Of several, none stays in memory after its turn."""
        for block in self.blocks:
            yield block.value if len(self.blocks) == 1 else block.load_from_path(block._path)

    @staticmethod
    def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(keys):
            return np.zeros(len(wanted), bool), np.zeros(len(wanted))
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return keys[at] == wanted, values[at]

    def learn(self, words: set[str]) -> None:
        new = [x for x in words if x not in self.known]
        if not new:
            return
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
            new = list(words)
        n = self.order
        codes = np.frombuffer((EDGE * (n - 1) + (EDGE * (n - 1)).join(new) + EDGE).encode("utf-32-le", "replace"), np.uint32)
        sizes = np.array([len(x) + 1 for x in new])
        first = np.cumsum(sizes + n - 2) - (sizes + n - 2)
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        windows = np.lib.stride_tricks.sliding_window_view(codes, n)[at]
        wanted, contexts, value = _key(windows), _key(windows[:, :-1]), np.zeros(len(windows))
        for grams, heads in self._tables():  # a context and its n-grams are in one block
            seen, own = self._found(*grams, wanted)
            known, other = self._found(*heads, contexts)
            value = np.where(seen, own, np.where(known, other, value))
        self.known.update(zip(new, np.add.reduceat(value, np.cumsum(sizes) - sizes).tolist(), strict=True))

    def features(self, texts: list[str | None], window: int) -> np.ndarray:
        """Mean ratio a word in the text, and in its most toxic run of words."""
        tokens = [words_of(t) for t in texts]
        self.learn(set().union(*tokens))
        result = np.zeros((len(texts), 2))
        for k, own in enumerate(tokens):
            if own:
                value = np.fromiter(map(self.known.__getitem__, own), float, len(own))
                name = np.fromiter(map(hash, own), np.int64, len(own))
                once, size = value.copy(), min(window, len(own))
                for back in range(1, size):  # a word that a run repeats says nothing new
                    once[back:][name[back:] == name[:-back]] = 0.0
                total = np.cumsum(np.r_[0.0, once])
                result[k] = value.mean(), (total[size:] - total[:-size]).max() / size
        return result


class ToxicityModel:
    """N-gram ratios and the logistic fit over the two features."""

    def __init__(self, blocks: list, coefficients: np.ndarray | None, order: int, window: int):
        self.blocks, self.coefficients, self.order, self.window = blocks, coefficients, order, window

    def score(self, docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, output: str = "score", raw: bool = False) -> DataFrame:
        """The documents' columns with ``score``, or with the two features where ``raw``."""
        keep = list(docs.columns) if keep is None else keep
        blocks, coefficients, order, window = self.blocks, self.coefficients, self.order, self.window
        most = SLICE * max(1, min(len(blocks), MOST_SLICES))
        names = [distinct_name(keep, x) for x in (("per_word", "per_window") if raw else (output,))]
        source = docs.select(*dict.fromkeys([*keep, text_col]))
        schema = source.select(*keep, *[F.lit(0.0).alias(x) for x in names]).schema

        def rate(batches):
            scores = WordScores(blocks, order)
            for batch in small_batches(batches, text_col, most):
                x = scores.features(batch.column(batch.schema.get_field_index(text_col)).to_pylist(), window)
                if raw:
                    values = [x[:, 0], x[:, 1]]
                elif coefficients is None:
                    values = [np.zeros(len(x))]
                else:
                    values = [1 / (1 + np.exp(-np.clip(coefficients[0] + x @ coefficients[1:], -700, 700)))]
                columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, values)], [*keep, *names])

        return source.mapInArrow(rate, schema)


def _shared(tables: tuple[DataFrame, DataFrame], order: int, block_grams: int) -> list:
    """Broadcast blocks of both tables as sorted keys and values; only one block at a time is on the driver."""
    grams, heads = tables
    spark, bucket = grams.sparkSession, F.pmod(F.xxhash64("head"), F.lit(1 << 20)).cast("int").alias("bucket")

    def keyed(length: int):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    keys = _keys(batch.column(1).to_pylist(), length).view(np.int64)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys), batch.column(2)], ["bucket", "key", "value"])

        return run

    parts = [
        materialize(frame.select(bucket, name, "value").mapInArrow(keyed(length), "bucket int, key long, value double"), "ratios")
        for frame, name, length in ((grams, "gram", order), (heads, "head", order - 1))
    ]
    result, blocks = [], max(1, -(-parts[0].count() // block_grams))
    for k in range(blocks):
        own = []
        for part in parts:
            found = part.where(F.pmod("bucket", F.lit(blocks)) == k).select("key", "value").toArrow()
            keys = found.column(0).to_numpy().view(np.uint64)
            place = np.argsort(keys)
            own.append((keys[place], found.column(1).to_numpy()[place]))
        result.append(spark.sparkContext.broadcast(tuple(own)))
    return result


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 200) -> np.ndarray:
    """Ridge-regularised logistic regression by Newton steps with halving, to convergence."""
    x = np.c_[np.ones(len(x)), x]
    penalty = ridge * np.r_[0.0, np.ones(x.shape[1] - 1)]

    def loss(b):
        z = x @ b
        return np.logaddexp(0, z).sum() - y @ z + 0.5 * (penalty * b * b).sum()

    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -700, 700)))
        gradient = x.T @ (p - y) + penalty * b
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty) + 1e-9 * np.eye(len(b)), gradient)
        size = 1.0
        while loss(b - size * step) > loss(b) and size > 1e-6:
            size /= 2
        b = b - size * step
        if np.abs(size * step).max() < 1e-8:
            return b
    return b


def fit(
    docs: DataFrame, labels: DataFrame, use: Column | None = None, order: int = ORDER, window: int = WINDOW, block_grams: int = BLOCK_GRAMS,
    calibration_rows: int = CALIBRATION_ROWS,
) -> ToxicityModel:
    """A model of all labelled rows of ``docs`` (doc_id, text) for which ``use`` (of doc_id) holds."""
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL")
    known = known.where(use) if use is not None else known
    known = materialize(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    texts = likely_rows(docs.select("doc_id", "text"), "doc_id", known).join(known, "doc_id")
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2)).cast("int")
    labelled = materialize(texts.withColumn("half", half), "labelled")
    sizes = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return ToxicityModel([], None, order, window)
    counts = materialize(gram_counts(labelled, order), "counts")
    backoff = shared_backoff(counts, order)
    rows = sum(sizes.values())
    sample = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(rows)) < calibration_rows)
    features = []
    for k in (0, 1):
        other = ToxicityModel(_shared(_class_model(counts.where(F.col("half") != k), backoff), order, block_grams), None, order, window)
        features.append(other.score(sample.where(F.col("half") == k), keep=["toxic"], raw=True).toArrow())
    table = pa.concat_tables(features)
    y = table.column("toxic").to_numpy().astype(float)
    x = np.c_[table.column("per_word").to_numpy(), table.column("per_window").to_numpy()]
    coefficients = _logistic(x, y) if 0 < y.sum() < len(y) else np.array([-1.0, 1.0, 1.0])
    return ToxicityModel(_shared(_class_model(counts, backoff), order, block_grams), coefficients, order, window)


def report(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted``; learns from labels outside fold 1 of 3."""
    model = fit(docs, labels, use=fold(3) != 1)
    told = model.score(docs.select("doc_id", "text"), keep=["doc_id"])
    held_out = F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out")
    return told.select("doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
