"""Components, conversations, first messages and resolution pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.operators import components, conversations as conv
from caseflow.plans.queries import base
from caseflow.sources import standin

BRAND = "brand_3"


def reply_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.reply_components(standin.linked_messages(spark, sf_dir))


def attach_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw, found = standin.messages_raw(spark, sf_dir), standin.components(spark, sf_dir)
    return conv.attach_components(raw, found).select("tweet_id", "component_id", "author_id")


def build_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = conv.build_conversations(standin.flawed_messages(spark, sf_dir), F.lit(BRAND))
    return built.select(
        "tweet_id", "component_id", "author_id", "inbound", F.unix_timestamp("created_at").alias("sent"), "turn_index"
    )


def drop_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv.drop_accounting(standin.flawed_messages(spark, sf_dir), F.lit(BRAND))


def build_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same accounts, taken while the conversations are written."""
    return conv.build_with_accounting(standin.flawed_messages(spark, sf_dir), F.lit(BRAND))[1]


def turn_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base.messages(spark, sf_dir).select("tweet_id", "component_id", "turn_index")


def first_inbound(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv.first_inbound(base.messages(spark, sf_dir)).select("component_id", "tweet_id", "turn_index", "text")


def first_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv.first_reply(base.messages(spark, sf_dir), F.lit(BRAND)).select(
        "component_id", "tweet_id", "turn_index", "author_id", "text"
    )


def component_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv.component_sizes(standin.with_components(spark, sf_dir))


def resolution_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv.resolution_pairs(*base.assigned(spark, sf_dir))


def corpus_intents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conv.corpus_intents(conv.resolution_pairs(*base.assigned(spark, sf_dir)))


def training_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, assignment = base.assigned(spark, sf_dir)
    return conv.labelled_first_messages(stored, assignment, conv.TRAIN_SPLIT).select(
        "component_id", "tweet_id", "heuristic_intent", "intent", "cleaned_text"
    )


def validation_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, assignment = base.assigned(spark, sf_dir)
    return conv.labelled_first_messages(stored, assignment, "validation").select(
        "component_id", "tweet_id", "heuristic_intent", "intent", "cleaned_text"
    )


QUERIES = {f.__name__: f for f in (
    reply_components, attach_components, build_conversations, drop_accounting, build_accounting, turn_index,
    first_inbound,
    first_reply, component_sizes, resolution_pairs, corpus_intents, training_set, validation_set,
)}

_KEPT = f"""raw_f AS (
  SELECT component_id, tweet_id, author_id, inbound, sent, tweet_id % 41 = 0 OR tweet_id % 43 = 0 OR trim(text) = '' OR text IS NULL AS bad_text,
         tweet_id % 47 = 0 AS bad_time FROM raw),
flags AS (
  SELECT component_id, bool_or(NOT inbound AND author_id = '{BRAND}') AS has_brand, bool_or(inbound) AS has_customer,
         count(DISTINCT CASE WHEN NOT inbound THEN author_id END) = 1 AS one_brand FROM raw GROUP BY 1)"""

_ACCOUNTS = f"""WITH {base.MSG}, {_KEPT},
    x AS (SELECT component_id, CASE WHEN NOT has_brand THEN 1 WHEN NOT has_customer THEN 2 WHEN NOT one_brand THEN 3
                 WHEN bad_text THEN 4 WHEN bad_time THEN 5 ELSE 9 END AS s FROM raw_f JOIN flags USING (component_id)),
    v(rule, k) AS (VALUES ('R1 brand reply', 1), ('R2 customer message', 2), ('R3 single brand', 3), ('R4 text', 4), ('R5 time', 5)),
    left_ AS (SELECT rule, k, count(DISTINCT component_id) FILTER (s > k) AS kept_components, count(*) FILTER (s > k) AS kept_rows,
                     count(DISTINCT component_id) FILTER (s >= k) - count(DISTINCT component_id) FILTER (s > k) AS dropped_components,
                     count(*) FILTER (s = k) AS dropped_rows FROM x, v GROUP BY rule, k)
    SELECT rule, dropped_components, dropped_rows, kept_components, kept_rows FROM left_"""


def _labelled(split: str) -> str:
    return f"""WITH {base.ASSIGN} SELECT component_id, tweet_id, s.heuristic_intent,
        {base.sql_label("s.heuristic_intent")} AS intent, {base.sql_clean("t.text")} AS cleaned_text
        FROM tagged t JOIN assignment s USING (component_id)
        WHERE s.split = '{split}' AND s.heuristic_intent NOT IN ('unmatched_other', 'non_english_out_of_scope')"""


ORACLES = {
    "reply_components": f"""WITH RECURSIVE {base.MSG},
        l AS (SELECT tweet_id, component_id AS conv, tweet_id % 1000 AS turn, component_id % 5 = 1 AS listed,
              CASE WHEN component_id % 13 = 5 AND tweet_id % 1000 = 0 THEN tweet_id + 1
                   WHEN component_id % 11 = 3 AND tweet_id % 1000 = 0 AND tweet_id <> {standin.HUB} THEN {standin.HUB}
                   WHEN component_id % 5 <> 1 OR component_id % 13 = 5 THEN parent END AS p FROM raw),
        answers AS (SELECT l.tweet_id, l.p FROM l SEMI JOIN raw ON raw.tweet_id = l.p),
        lists AS (SELECT l.tweet_id AS by_, x.tweet_id AS child FROM l JOIN raw x ON x.tweet_id IN (l.tweet_id + 1, l.tweet_id + 500) WHERE l.listed),
        starts AS (SELECT tweet_id FROM raw WHERE tweet_id NOT IN (SELECT tweet_id FROM answers) AND tweet_id NOT IN (SELECT child FROM lists)),
        rings AS (SELECT a.tweet_id FROM answers a JOIN answers b ON a.p = b.tweet_id AND b.p = a.tweet_id),
        ends AS (SELECT tweet_id AS a, p AS b FROM answers UNION SELECT p, tweet_id FROM answers UNION
                 SELECT by_, child FROM lists UNION SELECT child, by_ FROM lists),
        reach(s, at_) AS (SELECT tweet_id, tweet_id FROM (SELECT tweet_id FROM starts UNION SELECT tweet_id FROM rings) UNION
                 SELECT s, b FROM reach JOIN ends ON a = at_)
        SELECT at_ AS tweet_id, coalesce(min(s) FILTER (s IN (SELECT tweet_id FROM starts)), min(s)) AS component_id FROM reach GROUP BY 1""",
    "attach_components": f"WITH {base.MSG} SELECT tweet_id, component_id, author_id FROM raw",
    "build_conversations": f"""WITH {base.MSG}, {_KEPT}
        SELECT tweet_id, component_id, author_id, inbound, sent,
               row_number() OVER (PARTITION BY component_id ORDER BY sent, tweet_id) - 1 AS turn_index
        FROM raw_f JOIN flags USING (component_id) WHERE has_brand AND has_customer AND one_brand AND NOT bad_text AND NOT bad_time""",
    "drop_accounting": _ACCOUNTS,
    "build_accounting": _ACCOUNTS,
    "turn_index": f"WITH {base.MSG} SELECT tweet_id, component_id, turn_index FROM msg",
    "first_inbound": f"WITH {base.MSG} SELECT component_id, tweet_id, turn_index, text FROM first_in",
    "first_reply": f"""WITH {base.MSG} SELECT component_id, tweet_id, turn_index, author_id, text FROM msg
        WHERE NOT inbound AND author_id = '{BRAND}'
        QUALIFY row_number() OVER (PARTITION BY component_id ORDER BY turn_index) = 1""",
    "component_sizes": f"WITH {base.MSG} SELECT component_id, count(*) AS component_size FROM raw GROUP BY 1",
    "resolution_pairs": f"WITH {base.CORPUS} SELECT * FROM corpus",
    "corpus_intents": f"WITH {base.CORPUS} SELECT intent, count(*) AS pairs FROM corpus GROUP BY 1",
    "training_set": _labelled("train_retrieval"),
    "validation_set": _labelled("validation"),
}
