"""Splits, quota samples, benchmark labels and leakage checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.functions import packs
from caseflow.operators import conversations as conv
from caseflow.operators import splits, tagging
from caseflow.plans.queries import base
from caseflow.session import materialize, scratch_path
from caseflow.sources import standin, tables

TAGS = [*base.PACK.names, "unmatched_other", "non_english_out_of_scope"]
QUOTAS = {name: q for name, q in packs.GOLDEN_QUOTAS.items()}
ORDER_QUOTAS = {"1-URGENT": 500, "2-HIGH": 200, "3-MEDIUM": 100, "4-NOT SPECIFIED": 20, "5-LOW": 5}


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.assigned(spark, sf_dir)[1]


def orders_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return splits.stratified_split(orders, "o_orderkey", "o_orderpriority")


def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_stats(base.assigned(spark, sf_dir)[1], TAGS)


def messages_per_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.messages_per_split(*base.assigned(spark, sf_dir))


def split_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.split_violations(base.assigned(spark, sf_dir)[1])


def rare_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.rare_tags(base.assigned(spark, sf_dir)[1], ["address_redirect", "unauthorized_nonprime_charge"])


def quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return splits.quota_sample(orders, "o_orderpriority", "o_orderkey", ORDER_QUOTAS)


def mixed_quota_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority, where the line count stands for the number of rules hit."""
    lines = standin.table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.count_if(F.expr("l_quantity > 45")).cast("int").alias("hits"))
    pool = standin.table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "o_orderpriority", "hits")
    return splits.mixed_quota_sample(
        pool, ORDER_QUOTAS, "o_orderpriority", "o_orderkey", "hits", plain="5-LOW")


def _golden(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    stored, assignment = base.assigned(spark, sf_dir)
    golden = splits.build_golden_set(stored, assignment, base.PACK)
    return stored, assignment, materialize(golden, "golden")


def _labels(golden: DataFrame) -> DataFrame:
    """Stand-in labels: every third row moves to the next label, as a person might."""
    names = F.array(*[F.lit(x) for x in packs.TAXONOMY.all_labels])
    own = packs.TAXONOMY.label_of(F.col("heuristic_intent"))
    moved = F.element_at(names, (F.array_position(names, own) % len(packs.TAXONOMY.all_labels) + 1).cast("int"))
    tier = F.element_at(F.array(*[F.lit(x) for x in packs.DIFFICULTIES]), (F.col("component_id") % 3 + 1).cast("int"))
    third = F.col("component_id") % 3 == 0
    return golden.select(
        "golden_id", F.when(third, moved).otherwise(own).alias("human_intent"), tier.alias("difficulty"),
        F.when(third, "moved").otherwise("").alias("note"),
    )


def golden_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _golden(spark, sf_dir)[2]


def golden_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark written as CSV and read again, as a person would get and return it."""
    path = scratch_path(spark, "golden-csv")
    tables.write_csv(_golden(spark, sf_dir)[2].select(*schemas.GOLDEN.names), path)
    return tables.read_golden_csv(spark, path)


def apply_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    golden = _golden(spark, sf_dir)[2]
    return splits.apply_labels(golden, _labels(golden)).select(
        "golden_id", "component_id", "human_intent", "difficulty", "annotator_notes")


def label_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document labels against the documents, as a label table with gaps."""
    docs = standin.table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("golden_id"))
    given = standin.table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("golden_id"),
        F.when(F.col("toxic") == 1, "Toxic").when(F.col("quality") == 1, "Refund Request").alias("human_intent"),
        F.when(F.col("quality") == 1, "Easy").otherwise("").alias("difficulty"),
    )
    return splits.validate_labels(docs, given)


def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    golden = _golden(spark, sf_dir)[2]
    labelled = splits.apply_labels(golden, _labels(golden))
    return splits.label_distribution(labelled, ["human_intent", "difficulty", "heuristic_intent", "language_scope"])


def tag_label_disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    golden = _golden(spark, sf_dir)[2]
    return tagging.tag_label_disagreement(splits.apply_labels(golden, _labels(golden)))


def leakage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, assignment, golden = _golden(spark, sf_dir)
    return splits.split_leakage(assignment, golden, conv.resolution_pairs(stored, assignment))


def text_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by source: texts that more than one source holds."""
    docs = standin.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("component_id"), "text", "source")
    return splits.text_leakage(docs, docs.select("component_id", F.col("source").alias("split")))


QUERIES = {f.__name__: f for f in (
    stratified_split, orders_split, split_stats, messages_per_split, split_violations, rare_tags, quota_sample,
    mixed_quota_sample, golden_set, golden_csv, apply_labels, label_validation, label_distribution, tag_label_disagreement,
    leakage_check, text_leakage,
)}


def _values(quotas: dict[str, int]) -> str:
    return ", ".join(f"('{k}', {v}, {i})" for i, (k, v) in enumerate(quotas.items()))


def _mixed(pool: str, key: str, row_id: str, hits: str, quotas: dict[str, int], plain: str) -> str:
    return f"""
mx0 AS (SELECT p.*, v.quota, v.place AS bucket, p.{hits} >= 2 AND p.{key} <> '{plain}' AS is_multi
        FROM {pool} p JOIN (VALUES {_values(quotas)}) v(k, quota, place) ON p.{key} = v.k),
mx1 AS (SELECT *, row_number() OVER (PARTITION BY {key}, is_multi ORDER BY md5('{base.SEED}:' || {row_id}), {row_id}) AS rk,
        count(*) FILTER (is_multi) OVER (PARTITION BY {key}) AS pm, count(*) FILTER (NOT is_multi) OVER (PARTITION BY {key}) AS ps
        FROM mx0),
mx2 AS (SELECT *, least(quota, pm + ps) AS q FROM mx1),
mx3 AS (SELECT *, CASE WHEN {key} = '{plain}' THEN 0 ELSE least(CAST(round_even(q * 0.3, 0) AS BIGINT), pm) END AS nm FROM mx2),
mx4 AS (SELECT *, least(q - nm, ps) AS ns FROM mx3),
mixed AS (SELECT * FROM mx4 WHERE (is_multi AND rk <= nm + (q - nm - ns)) OR (NOT is_multi AND rk <= ns))"""


_GOLDEN = f"""
{base.ASSIGN},
pool AS (SELECT t.component_id, t.tweet_id, t.text, t.n_pattern_hits, s.heuristic_intent, s.split
         FROM tagged t JOIN assignment s USING (component_id)),
test_pool AS (SELECT * FROM pool WHERE split = 'test'),
{_mixed("test_pool", "heuristic_intent", "component_id", "n_pattern_hits", QUOTAS, "unmatched_other")},
sampled AS (
  SELECT component_id, tweet_id, text, n_pattern_hits, heuristic_intent, split, bucket, is_multi,
         CASE WHEN heuristic_intent = 'unmatched_other' THEN '{packs.NOTE_UNMATCHED}'
              WHEN is_multi THEN replace('{packs.NOTE_MULTI}', '{{}}', CAST(n_pattern_hits AS VARCHAR))
              ELSE '{packs.NOTE_SINGLE}' END AS note FROM mixed
  UNION ALL
  SELECT component_id, tweet_id, text, n_pattern_hits, heuristic_intent, split, {len(QUOTAS)}, false,
         '{packs.NOTE_NON_ENGLISH}'
  FROM (SELECT *, row_number() OVER (ORDER BY md5('{base.SEED}:' || component_id), component_id) AS rk
        FROM pool WHERE split = 'out_of_scope_non_english') WHERE rk <= {packs.NON_ENGLISH_QUOTA}),
numbered AS (SELECT *, row_number() OVER (ORDER BY bucket, is_multi DESC, md5('{base.SEED}:' || component_id), component_id) AS rn
             FROM sampled),
golden AS (
  SELECT 'g' || lpad(CAST(rn AS VARCHAR), 4, '0') AS golden_id, tweet_id AS source_tweet_id, component_id, text, heuristic_intent,
         '' AS human_intent, '' AS difficulty,
         CASE WHEN split = 'out_of_scope_non_english' THEN 'out_of_scope_non_english_heuristic' ELSE 'in_scope_english_heuristic' END AS language_scope,
         note AS annotator_notes, n_pattern_hits, c.component_size
  FROM numbered JOIN (SELECT component_id, count(*) AS component_size FROM raw GROUP BY 1) c USING (component_id))
"""

_names = packs.TAXONOMY.all_labels
_own = base.sql_label("heuristic_intent")
_list = "[" + ", ".join(f"'{x}'" for x in _names) + "]"
_LABELLED = f"""
{_GOLDEN},
labelled AS (
  SELECT golden_id, component_id, heuristic_intent, language_scope,
         CASE WHEN component_id % 3 = 0 THEN {_list}[list_position({_list}, {_own}) % {len(_names)} + 1] ELSE {_own} END AS human_intent,
         ['Easy', 'Medium', 'Hard'][component_id % 3 + 1] AS difficulty,
         annotator_notes || CASE WHEN component_id % 3 = 0 THEN ' | moved' ELSE '' END AS annotator_notes FROM golden)
"""

ORACLES = {
    "stratified_split": f"WITH {base.ASSIGN} SELECT * FROM assignment",
    "orders_split": f"""WITH strata AS (SELECT o_orderpriority AS stratum, count(*) AS n FROM orders GROUP BY 1),
        {base.sql_quotas("strata")},
        p AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
              ORDER BY md5('{base.SEED}:' || o_orderkey), o_orderkey) AS k FROM orders)
        SELECT o_orderkey, o_orderpriority, CASE WHEN k <= train THEN 'train_retrieval'
               WHEN k <= train + validation THEN 'validation' ELSE 'test' END AS split
        FROM p JOIN quotas ON stratum = o_orderpriority""",
    "split_stats": f"WITH {base.ASSIGN} SELECT split, " + ", ".join(
        f"count(*) FILTER (heuristic_intent = '{n}') AS {n}" for n in TAGS) + " FROM assignment GROUP BY 1",
    "messages_per_split": f"""WITH {base.ASSIGN}, m AS (SELECT component_id, count(*) AS m FROM raw WHERE inbound GROUP BY 1)
        SELECT split, count(*) AS components, CAST(coalesce(sum(m), 0) AS BIGINT) AS customer_messages
        FROM assignment LEFT JOIN m USING (component_id) GROUP BY 1""",
    "split_violations": f"""WITH {base.ASSIGN} SELECT component_id, count(*) AS rows, count(DISTINCT split) AS splits
        FROM assignment GROUP BY 1 HAVING count(*) > 1 OR count(DISTINCT split) > 1""",
    "rare_tags": f"""WITH {base.ASSIGN} SELECT heuristic_intent, split, count(*) AS n FROM assignment
        WHERE heuristic_intent IN ('address_redirect', 'unauthorized_nonprime_charge') GROUP BY 1, 2""",
    "quota_sample": f"""WITH p AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
        ORDER BY md5('{base.SEED}:' || o_orderkey), o_orderkey) AS rank FROM orders)
        SELECT o_orderkey, o_orderpriority, CAST(rank AS INT) AS rank FROM p
        JOIN (VALUES {_values(ORDER_QUOTAS)}) v(k, quota, place) ON k = o_orderpriority WHERE rank <= quota""",
    "mixed_quota_sample": f"""WITH li AS (SELECT l_orderkey, CAST(count(*) FILTER (l_quantity > 45) AS INT) AS hits FROM lineitem GROUP BY 1),
        pool AS (SELECT o_orderkey, o_orderpriority, hits FROM orders JOIN li ON o_orderkey = l_orderkey),
        {_mixed("pool", "o_orderpriority", "o_orderkey", "hits", ORDER_QUOTAS, "5-LOW")}
        SELECT o_orderkey, o_orderpriority, hits, is_multi FROM mixed""",
    "golden_set": f"WITH {_GOLDEN} SELECT * FROM golden",
    "golden_csv": f"WITH {_GOLDEN} SELECT {', '.join(schemas.GOLDEN.names)} FROM golden",
    "apply_labels": f"WITH {_LABELLED} SELECT golden_id, component_id, human_intent, difficulty, annotator_notes FROM labelled",
    "label_validation": f"""WITH g AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM documents),
        l AS (SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN toxic = 1 THEN 'Toxic' WHEN quality = 1 THEN 'Refund Request' END AS i,
              CASE WHEN quality = 1 THEN 'Easy' ELSE '' END AS d FROM labels)
        SELECT 'golden id without label' AS "check", (SELECT count(*) FROM g WHERE id NOT IN (SELECT id FROM l)) AS violations
        UNION ALL SELECT 'label without golden id', (SELECT count(*) FROM l WHERE id NOT IN (SELECT id FROM g))
        UNION ALL SELECT 'size difference', abs((SELECT count(*) FROM g) - (SELECT count(*) FROM l))
        UNION ALL SELECT 'intent not allowed', (SELECT count(*) FROM l WHERE i <> '' AND i NOT IN {base.sql_list(_names)})
        UNION ALL SELECT 'difficulty not allowed', (SELECT count(*) FROM l WHERE d <> '' AND d NOT IN ('Easy', 'Medium', 'Hard'))
        UNION ALL SELECT 'intent empty', (SELECT count(*) FROM l WHERE coalesce(i, '') = '')
        UNION ALL SELECT 'difficulty empty', (SELECT count(*) FROM l WHERE coalesce(d, '') = '')""",
    "label_distribution": f"WITH {_LABELLED} " + " UNION ALL ".join(
        f"SELECT '{c}' AS dimension, {c} AS value, count(*) AS n FROM labelled GROUP BY 2"
        for c in ("human_intent", "difficulty", "heuristic_intent", "language_scope")),
    "tag_label_disagreement": f"""WITH {_LABELLED} SELECT {_own} AS rule_label, human_intent, count(*) AS n FROM labelled
        WHERE heuristic_intent <> 'unmatched_other' AND {_own} <> human_intent GROUP BY 1, 2""",
    "leakage_check": f"""WITH {_GOLDEN},
        corpus AS (SELECT c.component_id FROM first_in c JOIN first_out a USING (component_id) JOIN assignment s USING (component_id)
          WHERE s.split = 'train_retrieval' AND a.turn_index > c.turn_index AND length(trim(a.text)) >= 15 AND length(trim(c.text)) >= 5)
        """ + " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", (SELECT count(DISTINCT component_id) FROM {a} WHERE component_id IN (SELECT component_id FROM {b})) AS overlap"""
        for name, a, b in (
            ("golden vs train", "golden", "assignment WHERE split = 'train_retrieval'"),
            ("golden vs validation", "golden", "assignment WHERE split = 'validation'"),
            ("corpus vs validation", "corpus", "assignment WHERE split = 'validation'"),
            ("corpus vs test", "corpus", "assignment WHERE split = 'test'"),
            ("corpus vs golden", "corpus", "golden"))),
    "text_leakage": f"""WITH g AS (SELECT {base.sql_normal("text")} AS norm, count(DISTINCT source) AS s, count(*) AS r FROM documents GROUP BY 1)
        SELECT count(*) FILTER (s > 1) AS shared_texts, CAST(coalesce(sum(r) FILTER (s > 1), 0) AS BIGINT) AS rows_with_shared_text FROM g""",
}
