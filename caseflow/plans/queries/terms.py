"""Term counts, lengths and TF-IDF tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import text as t
from caseflow.operators import conversations as conv
from caseflow.operators import features as fx
from caseflow.plans.queries import base
from caseflow.session import materialize, scratch_path
from caseflow.sources import standin, tables

# Stop words for the checked queries; the operators default to Spark's English list.
STOP = ("the", "of", "and", "to", "in", "is", "that", "was", "for", "on")


def top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = conv.first_inbound(base.messages(spark, sf_dir)).withColumn("norm", t.normalize_for_topics(F.col("text")))
    return fx.top_terms(first, "tweet_id", "norm", STOP)


def document_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = standin.table(spark, sf_dir, "documents").withColumn("norm", t.normalize_for_topics(F.col("text")))
    return fx.top_terms(docs, "doc_id", "norm", STOP)


def length_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.length_distribution(standin.table(spark, sf_dir, "documents")).select(
        "count", *[F.round(c, 4).alias(c) for c in ("mean", "std", "min", "max", "p10", "p25", "p50", "p75", "p90", "p95")])


def length_statistics_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length distribution written as JSON and read back."""
    path, found = scratch_path(spark, "length-statistics"), length_distribution(spark, sf_dir)
    tables.write_json(found, path)
    return spark.read.schema(found.schema).json(path)


def price_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.describe(standin.table(spark, sf_dir, "orders"), "o_totalprice").select(
        "count", *[F.round(c, 2).alias(c) for c in ("mean", "std", "min", "max", "p10", "p25", "p50", "p75", "p90", "p95")])


def _weights(docs: DataFrame, row_id: str, spec: fx.TermSpec) -> DataFrame:
    docs = docs.select(row_id, t.clean(F.col("text")).alias("text"))
    counts, vocab = fx.fit_terms(docs, row_id, "text", spec)
    vocab = materialize(vocab, "vocabulary")
    found = fx.postings(fx.weights(counts, vocab, row_id, spec), vocab, row_id)
    return found.select(row_id, "term", F.round("weight", 4).alias("weight"))


def word_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(standin.messages_raw(spark, sf_dir).where("inbound"), "tweet_id", fx.SEARCH_WORDS)


def classifier_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(standin.messages_raw(spark, sf_dir).where("inbound"), "tweet_id", fx.CLASSIFIER_WORDS)


def char_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _weights(standin.messages_raw(spark, sf_dir).where("inbound"), "tweet_id", fx.SEARCH_CHARS)


def document_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = standin.table(spark, sf_dir, "documents").select("doc_id", t.clean(F.col("text")).alias("text"))
    return fx.fit_terms(docs, "doc_id", "text", fx.SEARCH_CHARS)[1].select(
        "term", "df", "cf", F.round("idf", 4).alias("idf"), F.col("idx").cast("bigint").alias("idx"))


def feature_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and length of each message's joined sparse vector."""
    docs = standin.messages_raw(spark, sf_dir).where("inbound").select("tweet_id", t.clean(F.col("text")).alias("text"))
    blocks = []
    for spec in (fx.CLASSIFIER_WORDS, fx.CLASSIFIER_CHARS):
        counts, vocab = fx.fit_terms(docs, "tweet_id", "text", spec)
        vocab = materialize(vocab, "vocabulary")
        blocks.append((fx.weights(counts, vocab, "tweet_id", spec), vocab.count()))
    joined = fx.union_vectors(docs, "tweet_id", blocks, "features")
    parts = F.unwrap_udt("features")
    return joined.select(
        "tweet_id", F.size(parts["indices"]).cast("bigint").alias("known_terms"),
        F.round(F.aggregate(parts["values"], F.lit(0.0), lambda a, x: a + x * x), 4).alias("square_length"),
    )


QUERIES = {f.__name__: f for f in (
    top_terms, document_terms, length_distribution, length_statistics_file, price_distribution, word_tfidf, classifier_words, char_tfidf,
    document_vocabulary, feature_union,
)}


def sql_word_counts(docs: str, row_id: str, high: int, pattern: str, stop: tuple[str, ...] = (), name: str = "tf") -> str:
    """CTEs that end in ``<name>(id, term, tf)`` for word n-grams of ``docs(row_id, text)``."""
    skip = f"WHERE w NOT IN {base.sql_list(stop)}" if stop else ""
    joins = [
        f"SELECT a0.id, {' || chr(32) || '.join(f'a{i}.w' for i in range(n))} AS term FROM {name}_p a0 "
        + " ".join(f"JOIN {name}_p a{i} ON a{i}.id = a0.id AND a{i}.pos = a0.pos + {i}" for i in range(1, n))
        for n in range(1, high + 1)
    ]
    return f"""
{name}_l AS (SELECT {row_id} AS id, regexp_extract_all(lower(text), '{pattern}') AS ws FROM {docs}),
{name}_t AS (SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos0 FROM {name}_l),
{name}_p AS (SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY pos0) AS pos FROM {name}_t {skip}),
{name} AS (SELECT id, term, count(*) AS tf FROM ({" UNION ALL ".join(joins)}) GROUP BY 1, 2)"""


def sql_char_counts(docs: str, row_id: str, name: str = "tf") -> str:
    return f"""
{name}_w AS (SELECT {row_id} AS id, unnest(string_split_regex(lower(text), '\\s+')) AS w FROM {docs}),
{name}_c AS (SELECT id, ' ' || w || ' ' AS p, count(*) AS k FROM {name}_w WHERE w <> '' GROUP BY 1, 2),
{name}_n AS (SELECT id, p, k, unnest([3, 4, 5]) AS n FROM {name}_c),
{name}_s AS (SELECT id, p, k, n, unnest(range(1, CAST(length(p) AS BIGINT) - n + 2)) AS s FROM {name}_n WHERE n <= length(p)),
{name} AS (SELECT id, substring(p, s, n) AS term, CAST(sum(k) AS BIGINT) AS tf FROM {name}_s GROUP BY 1, 2)"""


def sql_weights(docs: str, min_df: int, limit: int, tf: str = "tf", name: str = "wt") -> str:
    """CTEs that end in ``<name>(id, term, weight)`` with sublinear counts."""
    return f"""
{name}_v AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf,
             ln((1.0 + (SELECT count(*) FROM {docs})) / (1.0 + count(*))) + 1 AS idf
             FROM {tf} GROUP BY 1 HAVING count(*) >= {min_df} ORDER BY cf DESC, term LIMIT {limit}),
{name}_w AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM {tf} JOIN {name}_v USING (term)),
{name} AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM {name}_w)"""


WORDS = r"[\p{L}\p{N}_]{2,}"
MARKS = r"[\p{L}\p{N}_]+|\$[0-9]+|[!?]+"
_DOCS = f"docs AS (SELECT tweet_id, {base.sql_clean('text')} AS text FROM raw WHERE inbound)"


def _tfidf(counts: str, min_df: int, limit: int) -> str:
    return f"""WITH {base.MSG}, {_DOCS}, {counts}, {sql_weights("docs", min_df, limit)}
        SELECT id AS tweet_id, term, round(weight, 4) AS weight FROM wt"""


def _top(docs: str, row_id: str) -> str:
    return f"""{sql_word_counts(docs, row_id, 2, WORDS, STOP)}
        SELECT term, CAST(sum(tf) AS BIGINT) AS count, count(*) AS docs FROM tf GROUP BY 1 HAVING count(*) >= 5
        ORDER BY 2 DESC, 1 LIMIT 200"""


def _describe(col: str, source: str, digits: int) -> str:
    quantiles = ", ".join(
        f"round(quantile_cont({col}, {p}), {digits}) AS p{int(p * 100)}" for p in (0.1, 0.25, 0.5, 0.75, 0.9, 0.95))
    return f"""SELECT count({col}) AS count, round(avg({col}), {digits}) AS mean, round(stddev_samp({col}), {digits}) AS std,
        CAST(min({col}) AS DOUBLE) AS min, CAST(max({col}) AS DOUBLE) AS max, {quantiles} FROM {source}"""


_words = base.sql_normal("text", " ")

ORACLES = {
    "top_terms": f"""WITH {base.MSG}, docs AS (SELECT tweet_id, {_words} AS text FROM first_in), {_top("docs", "tweet_id")}""",
    "document_terms": f"""WITH docs AS (SELECT doc_id, {_words} AS text FROM documents), {_top("docs", "doc_id")}""",
    "length_distribution": _describe("w", f"""(SELECT CAST(len(list_filter(string_split({_words}, ' '), lambda w: w <> '')) AS DOUBLE) AS w
        FROM documents)""", 4),
    "length_statistics_file": _describe("w", f"""(SELECT CAST(len(list_filter(string_split({_words}, ' '), lambda w: w <> '')) AS DOUBLE) AS w
        FROM documents)""", 4),
    "price_distribution": _describe("o_totalprice", "orders", 2),
    "word_tfidf": _tfidf(sql_word_counts("docs", "tweet_id", 2, WORDS), 2, 25000),
    "classifier_words": _tfidf(sql_word_counts("docs", "tweet_id", 3, MARKS), 2, 15000),
    "char_tfidf": _tfidf(sql_char_counts("docs", "tweet_id"), 3, 35000),
    "document_vocabulary": f"""WITH docs AS (SELECT doc_id, {base.sql_clean('text')} AS text FROM documents),
        {sql_char_counts("docs", "doc_id")}, {sql_weights("docs", 3, 35000)}
        SELECT term, df, cf, round(idf, 4) AS idf, row_number() OVER (ORDER BY term) - 1 AS idx FROM wt_v""",
    "feature_union": f"""WITH {base.MSG}, {_DOCS},
        {sql_word_counts("docs", "tweet_id", 3, MARKS, name="a")}, {sql_weights("docs", 2, 15000, "a", "aw")},
        {sql_char_counts("docs", "tweet_id", "b")}, {sql_weights("docs", 3, 25000, "b", "bw")},
        u AS (SELECT * FROM aw UNION ALL SELECT * FROM bw)
        SELECT tweet_id, count(u.id) AS known_terms, coalesce(round(sum(weight * weight), 4), 0) AS square_length
        FROM docs LEFT JOIN u ON u.id = tweet_id GROUP BY 1""",
}
