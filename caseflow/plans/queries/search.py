"""Hybrid search and its measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.operators import conversations as conv
from caseflow.operators import retrieval
from caseflow.plans.queries import base, terms
from caseflow.session import materialize, scratch_path


def _setting(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, retrieval.Index]:
    """Every customer message as a query, against an index of the train split's pairs."""
    stored, assignment = base.assigned(spark, sf_dir)
    index = retrieval.fit_index(conv.resolution_pairs(stored, assignment))
    label = packs.TAXONOMY.label_of(base.PACK.first_match(F.col("text")))
    queries = stored.where("inbound").select(F.col("tweet_id").cast("string").alias("q_id"), "text", label.alias("gold"))
    return queries, index


def _gapped(queries: DataFrame) -> DataFrame:
    """The same queries, some of which are without a text or without one that cleaning leaves."""
    n, text = F.col("q_id").cast("long"), F.col("text")
    asked = F.when(n % 41 != 0, F.when(n % 43 == 0, F.lit("@us https://a.b/c")).when(n % 47 == 0, F.lit("")).otherwise(text))
    return queries.withColumn("text", asked)


def _shape(best: DataFrame) -> DataFrame:
    return best.select("q_id", F.col("rank").cast("bigint").alias("rank"), "case_id", "score", "lexical_score",
                       "semantic_score", "intent", "is_sufficient")


def hybrid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, index = _setting(spark, sf_dir)
    return _shape(retrieval.topk(queries, index, 3))


def saved_index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search with an index that was saved and loaded."""
    queries, index = _setting(spark, sf_dir)
    path = scratch_path(spark, "index")
    retrieval.save_index(index, path)
    return _shape(retrieval.topk(_gapped(queries), retrieval.load_index(spark, path), 3))


def conditioned_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, index = _setting(spark, sf_dir)
    return _shape(retrieval.topk(queries, index, 5, intent="gold"))


def retrieval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search measured without a bonus, and with the true intent's bonus."""
    queries, index = _setting(spark, sf_dir)
    queries = _gapped(queries)
    parts = [
        retrieval.evaluate_retrieval(queries, index, "gold", how).withColumn("condition_on", F.lit(how or "none"))
        for how in (None, "gold")
    ]
    return materialize(parts[0].unionByName(parts[1]), "retrieval-metrics")


QUERIES = {f.__name__: f for f in (hybrid_topk, saved_index_topk, conditioned_topk, retrieval_metrics)}

_gold = base.sql_label(base.sql_first_match("text", base.PACK))


def sql_search(bonus: str, k: int, name: str = "best") -> str:
    return f"""
{name}_s AS (
  SELECT q.q_id, q.gold, c.case_id, c.intent, coalesce(l.s, 0) AS lex, coalesce(m.s, 0) AS sem,
         0.45 * coalesce(l.s, 0) + 0.55 * coalesce(m.s, 0)
           + CASE WHEN {bonus} THEN 0.15 * coalesce(m.s, 0) ELSE 0 END AS score
  FROM queries q CROSS JOIN corpus c
  LEFT JOIN lex_pairs l ON l.q_id = q.q_id AND l.case_id = c.case_id
  LEFT JOIN sem_pairs m ON m.q_id = q.q_id AND m.case_id = c.case_id),
{name} AS (
  SELECT q_id, gold, row_number() OVER (PARTITION BY q_id ORDER BY round(score, 9) DESC, case_id) AS rank, case_id,
         round(score, 4) AS score, round(lex, 4) AS lexical_score, round(sem, 4) AS semantic_score, intent,
         score >= 0.28 AS is_sufficient
  FROM {name}_s QUALIFY row_number() OVER (PARTITION BY q_id ORDER BY round(score, 9) DESC, case_id) <= {k})"""


def _pairs(kind: str, counts, min_df: int, limit: int) -> str:
    return f"""
{counts("cdocs", "case_id", f"{kind}_c")},
{terms.sql_weights("cdocs", min_df, limit, f"{kind}_c", f"{kind}_cw")},
{counts("qdocs", "q_id", f"{kind}_q")},
{kind}_qr AS (SELECT id, term, (1 + ln(tf)) * idf AS w FROM {kind}_q JOIN {kind}_cw_v USING (term)),
{kind}_qw AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM {kind}_qr),
{kind}_pairs AS (SELECT q.id AS q_id, c.id AS case_id, sum(q.weight * c.weight) AS s
                 FROM {kind}_qw q JOIN {kind}_cw c USING (term) GROUP BY 1, 2)"""


def sql_found(queries: str) -> str:
    """CTEs from ``corpus`` and a CTE text that ends in ``queries(q_id, text, gold)`` to both kinds of pair products."""
    return f"""
cdocs AS (SELECT case_id, cleaned_customer_text AS text FROM corpus),
{queries},
qdocs AS (SELECT q_id, text FROM queries),
{_pairs("lex", lambda d, i, n: terms.sql_word_counts(d, i, 2, terms.WORDS, name=n), 2, 25000)},
{_pairs("sem", lambda d, i, n: terms.sql_char_counts(d, i, n), 3, 35000)}"""


def _asked(text: str) -> str:
    return f"""queries AS (SELECT CAST(tweet_id AS VARCHAR) AS q_id, {base.sql_clean(text)} AS text, {_gold} AS gold
            FROM msg WHERE inbound AND {base.sql_clean(text)} <> '')"""


FOUND = f"{base.CORPUS},{sql_found(_asked('text'))}"
#: The same for queries some of which have no text left after cleaning.
GAPPED = f"{base.CORPUS},{sql_found(_asked("CASE WHEN tweet_id % 41 = 0 OR tweet_id % 43 = 0 OR tweet_id % 47 = 0 THEN '' ELSE text END"))}"

SAME = f"c.intent = q.gold AND q.gold IN {base.sql_list(packs.TAXONOMY.labels)}"
_columns = "q_id, rank, case_id, score, lexical_score, semantic_score, intent, is_sufficient"


def _metrics(best: str, how: str) -> str:
    return f"""SELECT '{how}' AS condition_on, count(*) AS total_queries,
        round(avg(CAST(coalesce(hit <= 1, false) AS INT)), 4) AS recall_at_1,
        round(avg(CAST(coalesce(hit <= 3, false) AS INT)), 4) AS recall_at_3,
        round(avg(CAST(coalesce(hit <= 5, false) AS INT)), 4) AS recall_at_5, round(avg(coalesce(1.0 / hit, 0)), 4) AS mrr,
        round(100 * avg(CAST(coalesce(hit = 1, false) AS INT)), 2) AS intent_concordance_top1_pct,
        round(100 * avg(CAST(coalesce(enough, false) AS INT)), 2) AS evidence_sufficiency_pct
        FROM (SELECT a.q_id, min(rank) FILTER (b.intent = a.gold) AS hit, bool_or(rank = 1 AND is_sufficient) AS enough
              FROM all_q a LEFT JOIN {best} b ON a.q_id = b.q_id GROUP BY 1)"""


ORACLES = {
    "hybrid_topk": f"WITH {FOUND}, {sql_search('false', 3)} SELECT {_columns} FROM best",
    "saved_index_topk": f"WITH {GAPPED}, {sql_search('false', 3)} SELECT {_columns} FROM best",
    "conditioned_topk": f"WITH {FOUND}, {sql_search(SAME, 5)} SELECT {_columns} FROM best",
    "retrieval_metrics": f"""WITH {GAPPED}, {sql_search('false', 5, "b0")}, {sql_search(SAME, 5, "b1")},
        all_q AS (SELECT CAST(tweet_id AS VARCHAR) AS q_id, {_gold} AS gold FROM msg WHERE inbound)
        {_metrics("b0", "none")} UNION ALL {_metrics("b1", "gold")}""",
}
