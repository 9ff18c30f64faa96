"""Frames and SQL fragments that the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions.rules import RulePack
from caseflow.operators import conversations as conv
from caseflow.operators import splits
from caseflow.session import materialize
from caseflow.sources import standin

PACK = standin.STANDIN_PACK
SEED = splits.SEED


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with parsed time and turn."""
    raw = standin.with_components(spark, sf_dir)
    timed = raw.withColumn("created_at", conv.parse_created_at(F.col("created_at")))
    return conv.turn_index(
        timed.select("tweet_id", "component_id", "author_id", "inbound", "created_at", "text")
    )


def stored_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written once, as the stages after the build read a table."""
    return materialize(messages(spark, sf_dir), "messages")


def assigned(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stored messages and their stored split assignment."""
    stored = stored_messages(spark, sf_dir)
    return stored, materialize(splits.assign_splits(stored, PACK), "assignment")


def sql_pattern(pattern: str) -> str:
    """A rule pattern for DuckDB, whose word ends are ASCII: ends become plain groups."""
    pieces, out = pattern.split(r"\b"), ""
    for n, piece in enumerate(pieces[:-1]):
        out += piece + (r"(^|[^\p{L}\p{N}_])" if n % 2 == 0 else r"($|[^\p{L}\p{N}_])")
    return (out + pieces[-1]).replace("'", "''")


def sql_match(col: str, pattern: str) -> str:
    return f"coalesce(regexp_matches(lower({col}), '{sql_pattern(pattern)}'), false)"


def sql_first_match(col: str, pack: RulePack) -> str:
    cases = " ".join(f"WHEN {sql_match(col, p)} THEN '{n}'" for n, p in pack.rules)
    return f"CASE {cases} ELSE '{pack.default}' END"


def sql_hit_count(col: str, pack: RulePack) -> str:
    return "(" + " + ".join(f"CAST({sql_match(col, p)} AS BIGINT)" for _, p in pack.rules) + ")"


def sql_label(tag: str) -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in packs.TAXONOMY.tag_to_label)
    return f"coalesce(CASE {tag} {cases} END, '{packs.TAXONOMY.fallback_label}')"


def sql_list(values) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def sql_clean(col: str) -> str:
    """The cleaning rules in DuckDB's regex dialect."""
    no_mention = rf"regexp_replace({col}, '@[\p{{L}}\p{{N}}_]+', '', 'g')"
    no_link = rf"regexp_replace({no_mention}, 'https?://\S+|www\.\S+', '', 'g')"
    kept = rf"regexp_replace({no_link}, '[^a-zA-Z0-9\s$.,!?''-]', ' ', 'g')"
    return rf"coalesce(trim(regexp_replace({kept}, '\s+', ' ', 'g')), '')"


def sql_normal(col: str, gap: str = "") -> str:
    bare = rf"regexp_replace(regexp_replace({col}, '@\S+', '{gap}', 'g'), 'https?://\S+', '{gap}', 'g')"
    return rf"coalesce(trim(regexp_replace(lower({bare}), '\s+', ' ', 'g')), '')"


MSG = """
raw AS (
  SELECT conv_id * 1000 + turn AS tweet_id, conv_id AS component_id,
         CASE WHEN role = 'user' THEN 'cust_' || conv_id WHEN role = 'system' THEN 'system'
              ELSE 'brand_' || ((conv_id + CASE WHEN conv_id % 7 = 0 THEN turn ELSE 0 END) % 10) END AS author_id,
         role = 'user' AS inbound, text,
         CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS parent,
         1509494400 + conv_id * 1000 + turn AS sent
  FROM conversations),
msg AS (
  SELECT *, row_number() OVER (PARTITION BY component_id ORDER BY tweet_id) - 1 AS turn_index FROM raw),
first_in AS (
  SELECT * FROM msg WHERE inbound
  QUALIFY row_number() OVER (PARTITION BY component_id ORDER BY turn_index) = 1),
first_out AS (
  SELECT * FROM msg WHERE NOT inbound
  QUALIFY row_number() OVER (PARTITION BY component_id ORDER BY turn_index) = 1)
"""


def _sql_share(source: str, count: str, target: str, output: str) -> str:
    """Largest-remainder shares of ``target`` rows, as two more CTE bodies."""
    return f"""
{output}_a AS (
  SELECT *, CAST(({target} * {count}) // sum({count}) OVER () AS BIGINT) AS fl,
         ({target} * {count}) % sum({count}) OVER () AS rest FROM {source}),
{output}_b AS (
  SELECT *, {target} - sum(fl) OVER () AS open,
         row_number() OVER (ORDER BY rest DESC, stratum) AS place FROM {output}_a)"""


def sql_quotas(strata: str) -> str:
    """CTEs that end in ``quotas(stratum, n, train, validation)``."""
    return f"""
q0 AS (SELECT stratum, n, CAST(sum(n) OVER () - ceil(sum(n) OVER () * CAST(0.2 AS DOUBLE)) AS BIGINT) AS goal FROM {strata}),
{_sql_share("q0", "n", "goal", "qt")},
q1 AS (SELECT stratum, n, fl + CAST(place <= open AS BIGINT) AS train FROM qt_b),
q2 AS (SELECT *, n - train AS held FROM q1),
q3 AS (SELECT *, CAST(sum(held) OVER () - ceil(sum(held) OVER () * CAST(0.5 AS DOUBLE)) AS BIGINT) AS goal FROM q2),
{_sql_share("q3", "held", "goal", "qv")},
quotas AS (SELECT stratum, n, train, fl + CAST(place <= open AS BIGINT) AS validation FROM qv_b)"""


ASSIGN = f"""
{MSG},
tagged AS (
  SELECT component_id, tweet_id, text, {sql_match("text", packs.SPLIT_LANGUAGE)} AS is_non_english,
         CASE WHEN {sql_match("text", packs.SPLIT_LANGUAGE)} THEN 'non_english_out_of_scope'
              ELSE {sql_first_match("text", PACK)} END AS heuristic_intent,
         {sql_hit_count("text", PACK)} AS n_pattern_hits
  FROM first_in),
strata AS (
  SELECT heuristic_intent AS stratum, count(*) AS n FROM tagged WHERE NOT is_non_english GROUP BY 1),
{sql_quotas("strata")},
placed AS (
  SELECT *, row_number() OVER (PARTITION BY heuristic_intent ORDER BY md5('{SEED}:' || component_id), component_id) AS place
  FROM tagged WHERE NOT is_non_english),
assignment AS (
  SELECT component_id, heuristic_intent, is_non_english,
         CASE WHEN place <= train THEN 'train_retrieval' WHEN place <= train + validation THEN 'validation'
              ELSE 'test' END AS split
  FROM placed JOIN quotas ON stratum = heuristic_intent
  UNION ALL
  SELECT component_id, heuristic_intent, is_non_english, 'out_of_scope_non_english' FROM tagged WHERE is_non_english)
"""

SQL_CORPUS = f"""
corpus AS (
  SELECT 'case_' || c.component_id AS case_id, c.component_id, trim(c.text) AS customer_text,
         {sql_clean("trim(c.text)")} AS cleaned_customer_text, trim(a.text) AS agent_reply,
         {sql_label("s.heuristic_intent")} AS intent
  FROM first_in c JOIN first_out a USING (component_id) JOIN assignment s USING (component_id)
  WHERE s.split = 'train_retrieval' AND a.turn_index > c.turn_index
    AND length(trim(a.text)) >= 15 AND length(trim(c.text)) >= 5)
"""

CORPUS = f"{ASSIGN},{SQL_CORPUS}"
