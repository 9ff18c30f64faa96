"""Term counts and TF-IDF as tables.

A document's terms are counted inside the partition that holds the document: the short
``(id, text)`` rows are shuffled once by id, and every later grouping by id, or by id and
term, finds the rows in place. The exploded terms never travel, except as per-partition
sums on the way to the vocabulary.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass

from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.operators.ranks import quantile_bins
from caseflow.session import materialize

# Token patterns. Words have two characters or more unless stated.
WORD = r"\b\w\w+\b"
WORD_MONEY_MARKS = r"\b\w+\b|\$[\d]+|[!?]+"

# Characters of text a task: what it counts stays in its memory.
TASK_CHARACTERS = 4_000_000


@dataclass(frozen=True)
class TermSpec:
    """How texts become weighted terms."""

    kind: str = "word"
    low: int = 1
    high: int = 1
    token: str = WORD
    stop_words: tuple[str, ...] = ()
    sublinear: bool = False
    min_df: int = 1
    max_features: int | None = None


def save_specs(spark: SparkSession, specs: list["TermSpec"], path: str) -> None:
    """Settings next to what was fitted with them, as one JSON line for each."""
    rows = [(n, json.dumps(asdict(spec))) for n, spec in enumerate(specs)]
    spark.createDataFrame(rows, "n int, spec string").coalesce(1).write.mode("overwrite").json(path)


def load_specs(spark: SparkSession, path: str) -> list["TermSpec"]:
    rows = spark.read.schema("n int, spec string").json(path).orderBy("n").collect()
    found = [json.loads(r["spec"]) for r in rows]
    return [TermSpec(**{**x, "stop_words": tuple(x["stop_words"])}) for x in found]


def english_stop_words() -> tuple[str, ...]:
    return tuple(StopWordsRemover.loadDefaultStopWords("english"))


# The configurations that classifier, baselines, search and studies use.
CLASSIFIER_WORDS = TermSpec("word", 1, 3, WORD_MONEY_MARKS, (), True, 2, 15_000)
CLASSIFIER_CHARS = TermSpec("char", 3, 5, WORD, (), True, 3, 25_000)
SEARCH_WORDS = TermSpec("word", 1, 2, WORD, (), True, 2, 25_000)
SEARCH_CHARS = TermSpec("char", 3, 5, WORD, (), True, 3, 35_000)


def baseline_words(stop_words: tuple[str, ...]) -> TermSpec:
    return TermSpec("word", 1, 1, WORD, stop_words, False, 1, 5_000)


def topic_words(stop_words: tuple[str, ...]) -> TermSpec:
    return TermSpec("word", 1, 2, WORD, stop_words, False, 5, 6_000)


def brand_words(stop_words: tuple[str, ...]) -> TermSpec:
    return TermSpec("word", 1, 1, WORD, stop_words, False, 3, 3_000)


def tokens(text: Column, spec: TermSpec) -> Column:
    found = F.regexp_extract_all(F.lower(text), F.lit("(?U)" + spec.token), F.lit(0))
    if spec.stop_words:
        found = F.filter(found, lambda w: ~w.isin(*spec.stop_words))
    return found


def word_ngrams(toks: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` tokens, joined by one space.

    Runs of n are runs of n - 1 zipped with the tokens n - 1 further on, so the work is
    linear in the text; the padding at the end gives nulls, which are dropped.
    """
    runs, parts = toks, []
    for n in range(1, high + 1):
        if n > 1:
            later = F.slice(toks, n, 2_000_000_000)
            runs = F.array_compact(F.zip_with(runs, later, lambda a, b: F.concat(a, F.lit(" "), b)))
        if n >= low:
            parts.append(runs)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_ngrams(words: DataFrame, keep: list[str], low: int, high: int) -> DataFrame:
    """``keep..., term``: all runs of characters of each ``word``, padded by a space a side.

    A word shorter than ``low`` gives itself once. Start and length are exploded and the
    runs are cut by ``substring``, which stays in generated code, unlike nested lambdas.
    """
    padded = words.select(*keep, F.concat(F.lit(" "), "word", F.lit(" ")).alias("_p"))
    starts = padded.select(*keep, "_p", F.length("_p").alias("_n"), F.explode(F.sequence(F.lit(1), F.length("_p"))).alias("_at"))
    runs = starts.select(*keep, "_p", "_n", "_at", F.explode(F.array(*[F.lit(n) for n in range(low, high + 1)])).alias("_len"))
    fits = F.col("_at") + F.col("_len") - 1 <= F.col("_n")
    short = (F.col("_at") == 1) & (F.col("_len") == low) & (F.col("_n") < low)
    return runs.where(fits | short).select(*keep, F.substring(F.col("_p"), F.col("_at"), F.col("_len")).alias("term"))


def term_counts(docs: DataFrame, row_id: str, text: str, spec: TermSpec, by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., row_id, term, tf``, one row per document and term.

    The number of partitions is the session's, or more where a task would get more than ``TASK_CHARACTERS``: cutting up
    texts costs far more than their bytes suggest, so adaptive execution must not merge them by size.
    """
    size = docs.agg(F.sum(F.length(text))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_CHARACTERS))
    placed = docs.select(*by, row_id, text).repartition(parts, F.col(row_id))
    if spec.kind == "word":
        split = placed.select(*by, row_id, tokens(F.col(text), spec).alias("toks"))
        terms = split.select(*by, row_id, F.explode(word_ngrams(F.col("toks"), spec.low, spec.high)).alias("term"))
        return terms.groupBy(*by, row_id, "term").agg(F.count("*").alias("tf"))
    # a repeated word is cut up once, and its n-grams count as often as it occurs
    spaced = F.split(F.regexp_replace(F.lower(text), r"(?U)\s+", " "), " ")
    found = placed.select(*by, row_id, F.explode(spaced).alias("word")).where("word <> ''")
    counted = found.groupBy(*by, row_id, "word").agg(F.count("*").alias("n"))
    grams = char_ngrams(counted, [*by, row_id, "n"], spec.low, spec.high)
    return grams.groupBy(*by, row_id, "term").agg(F.sum("n").alias("tf"))


def vocabulary(counts: DataFrame, doc_count: DataFrame, spec: TermSpec, by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., term, df, cf, idf, idx``; the most frequent terms if there is a limit.

    ``doc_count`` holds ``by..., n_docs``. Equal counts go by term, so the choice does not
    depend on row order.
    """
    return chosen(counts.groupBy(*by, "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf")), doc_count, spec, by)


def chosen(totals: DataFrame, doc_count: DataFrame, spec: TermSpec, by: tuple[str, ...] = ()) -> DataFrame:
    """``vocabulary`` from ``by..., term, df, cf``."""
    from pyspark.sql import Window as W

    totals = totals.where(F.col("df") >= spec.min_df)
    group = list(by) or [F.lit(1)]
    if spec.max_features:
        if by:
            from caseflow.operators.ranks import top_n

            totals = top_n(totals, list(by), [F.desc("cf"), F.col("term")], spec.max_features, "term").drop("rank")
        else:
            totals = totals.orderBy(F.desc("cf"), "term").limit(spec.max_features)
        # at most max_features terms per group are left for this window
        totals = totals.withColumn("idx", F.row_number().over(W.partitionBy(*group).orderBy("term")) - 1)
    else:
        totals = totals.withColumn("idx", F.lit(None).cast("int"))
    if by:
        joined, n_docs = totals.join(doc_count, list(by)), F.col("n_docs")
    else:
        joined, n_docs = totals, F.lit(doc_count.first()[0])
    idf = F.log((n_docs + 1) / (F.col("df") + 1)) + 1
    return joined.select(*by, "term", "df", "cf", idf.alias("idf"), "idx")


def count_docs(docs: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return docs.groupBy(*by).agg(F.count("*").alias("n_docs"))


def weights(counts: DataFrame, vocab: DataFrame, row_id: str, spec: TermSpec, by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., row_id, idx, val``: index and unit-length weight arrays per document.

    A capped vocabulary has at most ``max_features`` rows of short strings (35,000 rows,
    about 2 MB) and is broadcast; an uncapped or per-group one is left to the planner.
    """
    table = vocab.select(*by, "term", "idf", "idx")
    if spec.max_features and not by:
        table = F.broadcast(table)
    tf = F.col("tf").cast("double")
    scaled = (F.lit(1.0) + F.log(tf)) if spec.sublinear else tf
    weighed = counts.join(table, [*by, "term"]).withColumn("w", scaled * F.col("idf"))
    # the list of one document is bounded by the vocabulary; the length comes from the same
    # grouping, since a norm computed inside the lambda would run once per element
    packed = weighed.groupBy(*by, row_id).agg(
        F.sort_array(F.collect_list(F.struct("idx", "w"))).alias("p"),
        F.sum(F.col("w") * F.col("w")).alias("_square"),
    )
    return packed.select(
        *by, row_id,
        F.col("p.idx").alias("idx"),
        F.transform("p", lambda x: x["w"] / F.sqrt("_square")).alias("val"),
    )


def postings(vectors: DataFrame, vocab: DataFrame, row_id: str) -> DataFrame:
    """``row_id, term, weight`` in long form."""
    flat = vectors.select(row_id, F.explode(F.arrays_zip("idx", "val")).alias("e"))
    return flat.select(row_id, F.col("e.idx").alias("idx"), F.col("e.val").alias("weight")).join(
        vocab.select("idx", "term"), "idx"
    ).select(row_id, "term", "weight")


def fit_terms(docs: DataFrame, row_id: str, text: str, spec: TermSpec) -> tuple[DataFrame, DataFrame]:
    """Term counts and vocabulary of a corpus."""
    counts = term_counts(docs, row_id, text, spec)
    return counts, vocabulary(counts, count_docs(docs), spec)


def top_terms(
    docs: DataFrame, row_id: str, text: str, stop_words: tuple[str, ...], n: int = 200, min_df: int = 5
) -> DataFrame:
    """Most frequent words and word pairs; stop words leave before pairs are formed."""
    spec = TermSpec("word", 1, 2, WORD, stop_words)
    counts = term_counts(docs, row_id, text, spec)
    return (
        counts.groupBy("term").agg(F.sum("tf").alias("count"), F.count("*").alias("docs"))
        .where(F.col("docs") >= min_df)
        .orderBy(F.desc("count"), "term").limit(n)
    )


POINTS = (0.1, 0.25, 0.5, 0.75, 0.9, 0.95)


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact percentiles of a numeric column.

    Percentiles interpolate between two ranks. Distinct values are counted, cut into bins of about
    equally many and numbered within a bin, after the rows of lower bins; no task holds all
    values, and the rows around the wanted ranks are all that is left at the end.
    """
    from pyspark.sql import Window as W

    stats = df.agg(
        F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
        F.min(col).cast("double").alias("min"), F.max(col).cast("double").alias("max"),
    ).first()
    n = stats["count"]
    values = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("v")).agg(F.count("*").alias("ties"))
    values = values.withColumn("bin", quantile_bins(values, "v"))
    before = W.partitionBy(F.lit(1)).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = values.groupBy("bin").agg(F.sum("ties").alias("rows")).select(
        "bin", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"))
    within = W.partitionBy("bin").orderBy("v").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("shift") + F.coalesce(F.sum("ties").over(within), F.lit(0))
    placed = values.join(bins, "bin").select("v", start.alias("start"), (start + F.col("ties")).alias("stop"))

    def at(rank: int) -> Column:
        return F.max(F.when((F.col("start") <= rank) & (F.lit(rank) < F.col("stop")), F.col("v")))

    spread = []
    for p in POINTS:
        exact = max(n - 1, 0) * p
        below = at(math.floor(exact))
        spread.append((below + (at(math.ceil(exact)) - below) * (exact - math.floor(exact))).alias(f"p{int(p * 100)}"))
    known = [F.lit(stats[c]).cast("long" if c == "count" else "double").alias(c) for c in ("count", "mean", "std", "min", "max")]
    return placed.agg(*spread).select(*known, "*")


def length_distribution(messages: DataFrame) -> DataFrame:
    from caseflow.functions import text as t

    return describe(messages.select(t.word_count(F.col("text")).alias("words")), "words")


_VECTOR_STRUCT = T.StructType([T.StructField("v", VectorUDT())])


def to_sparse(idx: Column, val: Column, size: int) -> Column:
    """ML vector from index and value arrays without leaving the JVM."""
    body = F.to_json(F.struct(F.struct(
        F.lit(0).alias("type"), F.lit(size).alias("size"), idx.alias("indices"), val.alias("values")
    ).alias("v")))
    return F.from_json(body, _VECTOR_STRUCT)["v"]


def _shifted(idx: Column, by: int) -> Column:
    return F.transform(idx, lambda i: i + by)


def union_entries(ids: DataFrame, row_id: str, blocks: list[tuple[DataFrame, int]], idx: str, val: str) -> tuple[DataFrame, int]:
    """Rows of ``ids`` with the entries of their vector as two arrays, blocks of weights side by side, and the vector's size.

    Rows without any known term get empty arrays.
    """
    joined, offset = ids, 0
    places, values = [], []
    for n, (block, size) in enumerate(blocks):
        joined = joined.join(block.select(row_id, F.col("idx").alias(f"_i{n}"), F.col("val").alias(f"_v{n}")), row_id, "left")
        places.append(_shifted(F.coalesce(f"_i{n}", F.array().cast("array<int>")), offset))
        values.append(F.coalesce(f"_v{n}", F.array().cast("array<double>")))
        offset += size
    found = joined.withColumn(idx, F.concat(*places)).withColumn(val, F.concat(*values))
    return found.drop(*[f"_{k}{n}" for n in range(len(blocks)) for k in "iv"]), offset


def joined_entries(rows: DataFrame, names: list[tuple[str, str]], sizes: list[int], idx: str, val: str) -> tuple[DataFrame, int]:
    """The same where ``rows`` hold places and weights for each spec."""
    places, values, offset = [], [], 0
    for (i, v), size in zip(names, sizes):
        places.append(_shifted(F.coalesce(i, F.array().cast("array<int>")), offset))
        values.append(F.coalesce(v, F.array().cast("array<double>")))
        offset += size
    found = rows.withColumn(idx, F.concat(*places)).withColumn(val, F.concat(*values))
    return found.drop(*[c for pair in names for c in pair]), offset


def fit_vocabularies(docs: DataFrame, row_id: str, text: str, specs: list[TermSpec]) -> list[DataFrame]:
    """Stored vocabularies of a corpus. Where all specs limit their terms, none has a row for each term of a document (``operators.grams``)."""
    from caseflow.operators import grams

    if all(spec.max_features for spec in specs):
        rows = grams.placed(docs, row_id, text, specs).persist()
        try:
            return grams.vocabularies(rows, count_docs(docs), specs)
        finally:
            rows.unpersist()
    return [materialize(fit_terms(docs, row_id, text, spec)[1], "vocabulary") for spec in specs]


def places(vocabs: list[DataFrame]) -> dict:
    """Sizes of limited vocabularies, and ``idf`` of their terms by place, one vocabulary after another."""
    import numpy as np

    told = [v.orderBy("idx").select("idf").toArrow() for v in vocabs]
    return {"sizes": [x.num_rows for x in told], "idf": np.concatenate([x.column("idf").to_numpy().astype(float) for x in told])}


def union_vectors(ids: DataFrame, row_id: str, blocks: list[tuple[DataFrame, int]], output: str) -> DataFrame:
    """One sparse vector per row of ``ids`` from blocks of weights side by side.

    Rows without any known term get an empty vector.
    """
    joined, size = union_entries(ids, row_id, blocks, "_idx", "_val")
    return joined.withColumn(output, to_sparse(F.col("_idx"), F.col("_val"), size)).drop("_idx", "_val")
