"""Gate, drafted replies, prompts and rubric over every customer message.

Model outputs are stood in for by columns derived from the message ids, so that each
branch occurs and plain SQL can check it. ``triage_messages`` runs the fitted models.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions import text as t
from caseflow.operators import conversations as conv
from caseflow.operators import replies
from caseflow.plans.queries import base


def scored_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer message with a derived prediction, a first case and labels.

    A case's reply is the conversation's whole first reply, or a short text of its own where the id is divisible by
    three, so that reused and template replies both occur.
    """
    stored = base.stored_messages(spark, sf_dir)
    tid, labels = F.col("tweet_id"), packs.TAXONOMY.all_labels
    names = F.array(*[F.lit(x) for x in labels])
    first = conv.first_reply(stored).select("component_id", F.col("text").alias("reply"))
    own = packs.TAXONOMY.label_of(base.PACK.first_match(F.col("text")))
    moved = F.element_at(names, (F.array_position(names, F.col("intent")) % len(labels) + 1).cast("int"))
    rows = (
        stored.where("inbound").join(first, "component_id", "left")
        .withColumn("intent", own)
        .withColumn("confidence", F.round((tid * 7) % 997 / 997.0, 4))
        .withColumn("margin", F.round((tid * 13) % 311 / 1000.0, 4))
        .withColumn("top_score", F.when(tid % 11 > 0, F.round((tid * 17) % 991 / 991.0, 4)))
        .withColumn("human_intent", F.when(tid % 4 == 0, moved).otherwise(F.col("intent")))
        .withColumn("difficulty", F.element_at(F.array(*[F.lit(x) for x in packs.DIFFICULTIES]), (tid % 3 + 1).cast("int")))
    )
    piece = F.concat(
        F.lit("@cust "), F.when(tid % 3 == 0, F.concat(F.lit("ok "), tid.cast("string"))).otherwise(F.coalesce("reply", F.lit(""))),
        F.when(tid % 5 == 0, " We have refunded you, please check. ^AB").otherwise(" -XY"),
    )
    case = F.struct(
        t.case_id(F.col("component_id")).alias("case_id"), piece.alias("agent_reply"),
        F.col("top_score").alias("similarity_score"), F.col("intent"), F.col("text").alias("historical_customer_text"),
        piece.alias("historical_agent_reply"),
    )
    return rows.withColumn(
        "evidence", F.when(F.col("top_score").isNotNull(), F.array(case)).otherwise(F.filter(F.array(case), lambda _: F.lit(False))))


def full(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = replies.decide(scored_messages(spark, sf_dir))
    return replies.score_reply(replies.draft_reply(decided))


def escalation_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.decide(scored_messages(spark, sf_dir)).select(
        "tweet_id", F.array_join("reason_codes", ",").alias("codes"), "decision", "reason",
        F.array_join("reasons", " / ").alias("reasons"))


def draft_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.draft_reply(scored_messages(spark, sf_dir)).select(
        "tweet_id", "suggested_reply", "is_grounded", F.array_join("evidence_ids", ",").alias("evidence_ids"), "primary_case")


def evidence_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.evidence_prompt(scored_messages(spark, sf_dir)).select("tweet_id", F.md5("prompt").alias("prompt_md5"))


SCORES = ("relevance", "groundedness", "factual_safety", "actionability", "tone", "conciseness", "total_score")


def score_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return full(spark, sf_dir).select(
        "tweet_id", *[F.col(c).cast("bigint").alias(c) for c in SCORES], "average_score",
        F.array_join("unsupported_claims", "|").alias("claims"), "is_factually_safe")


def proxy_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = replies.proxy_review_scores(replies.draft_reply(scored_messages(spark, sf_dir)))
    names = ("relevance", "groundedness", "factual_safety", "actionability", "tone", "conciseness", "total_score")
    return rated.select("tweet_id", *[F.col(f"review_{n}").cast("bigint").alias(f"review_{n}") for n in names], "review_average_score")


QUERIES = {f.__name__: f for f in (escalation_codes, draft_reply, evidence_prompt, score_reply, proxy_review)}

_names = packs.TAXONOMY.all_labels
_list = "[" + ", ".join(f"'{x}'" for x in _names) + "]"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _two(col: str) -> str:
    return f"printf('%.2f', {col})"


def _any(col: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains({col}, {_q(n)})" for n in needles) + ")"


_gate = (
    f"({base.sql_match('text', packs.GATE_LANGUAGE)} OR regexp_matches(text, "
    r"'[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{0600}-\x{06ff}\x{0400}-\x{04ff}]'))"
)


def _fill(template: str, *values: str) -> str:
    """A sentence of the fixed values with SQL expressions in its gaps."""
    pieces = template.split("{}")
    return " || ".join(x for k, piece in enumerate(pieces) for x in (_q(piece), *values[k : k + 1]))


def _reason(code: str, *values: str) -> str:
    return _fill(packs.GATE_REASONS[code], *values)


_checks = [
    ("UNSUPPORTED_LANGUAGE", _gate, _reason("UNSUPPORTED_LANGUAGE")),
    ("EXPLICIT_HUMAN_REQUEST", base.sql_match("text", packs.GATE_HUMAN), _reason("EXPLICIT_HUMAN_REQUEST")),
    ("HIGH_RISK_INTENT", f"intent IN {base.sql_list(packs.TAXONOMY.high_risk)}", _reason("HIGH_RISK_INTENT", "intent")),
    ("OUT_OF_SCOPE_INTENT", f"intent NOT IN {base.sql_list(packs.TAXONOMY.labels)}", _reason("OUT_OF_SCOPE_INTENT")),
    ("LOW_INTENT_CONFIDENCE", "confidence < 0.52", _reason("LOW_INTENT_CONFIDENCE", _two("confidence"), "'0.52'")),
    ("AMBIGUOUS_INTENT_MARGIN", "confidence >= 0.52 AND margin < 0.08", _reason("AMBIGUOUS_INTENT_MARGIN", _two("margin"))),
    ("NO_HISTORICAL_EVIDENCE", "top_score IS NULL", _reason("NO_HISTORICAL_EVIDENCE")),
    ("LOW_RETRIEVAL_CONFIDENCE", "coalesce(top_score < 0.28, false)", _reason("LOW_RETRIEVAL_CONFIDENCE", _two("top_score"), "'0.28'")),
]
_codes = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c, _ in _checks) + "], lambda x: x IS NOT NULL)"
_reasons = "list_filter([" + ", ".join(f"CASE WHEN {c} THEN {w} END" for _, c, w in _checks) + "], lambda x: x IS NOT NULL)"
_scrubbed = (
    r"trim(regexp_replace(trim(regexp_replace(regexp_replace(piece, '@[\p{L}\p{N}_]+', '', 'g'), '\s+', ' ', 'g')), "
    r"'[\^–-][A-Z]{1,3}\s*$', ''))"
)
_template = "CASE intent " + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in packs.REPLY_TEMPLATES.items()) + f" ELSE {_q(packs.REPLY_DEFAULT)} END"
_relevance = "CASE WHEN length(suggested_reply) < 15 THEN 2 " + " ".join(
    f"WHEN intent = {_q(k)} AND {_any('lo', v)} THEN 5" for k, v in replies.RELEVANT_WORDS.items()) + " ELSE 4 END"
_refund, _action = _any("lo", replies.CLAIMED_REFUND), _any("lo", replies.CLAIMED_ACTION)

def sql_decided(source: str) -> str:
    """CTEs that end in ``s3``: codes, decision, reason and reply for ``intent, confidence, margin, top_score, piece``."""
    return f"""s2 AS (SELECT *, {_codes} AS codes, {_reasons} AS why, {_scrubbed} AS scrubbed FROM {source}),
s3 AS (
  SELECT *, CASE WHEN len(codes) > 0 THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END AS decision,
         CASE WHEN len(codes) > 0 THEN why[1] ELSE {_fill(packs.GATE_CLEAR, _two('confidence'), _two('top_score'))} END AS reason,
         CASE WHEN top_score IS NULL THEN {_q(packs.REPLY_NO_EVIDENCE)}
              WHEN length(scrubbed) >= 20 AND NOT starts_with(lower(scrubbed), '{replies.NOT_REUSED}') THEN scrubbed
              ELSE {_template} END AS suggested_reply FROM s2),"""


def sql_scored(source: str) -> str:
    """CTEs that end in ``scored``: the decision, the rubric and the second rating; ``source`` also has ``human_intent``."""
    return f"""{sql_decided(source)}
s4 AS (SELECT *, lower(suggested_reply) AS lo FROM s3),
s5 AS (
  SELECT *, {_relevance} AS relevance,
         CASE WHEN top_score IS NULL THEN 3 WHEN {_refund} OR {_action} THEN 1 WHEN top_score < 0.30 THEN 3
              WHEN top_score > 0.45 THEN 5 ELSE 4 END AS groundedness,
         CASE WHEN {_refund} OR {_action} THEN 1 ELSE 5 END AS factual_safety,
         CASE WHEN {_any("lo", replies.ACTION_WORDS)} THEN 5 ELSE 3 END AS actionability,
         CASE WHEN {_any("lo", replies.KIND_WORDS)} THEN 5 ELSE 4 END AS tone,
         CASE WHEN length(suggested_reply) > 280 THEN 3 WHEN length(suggested_reply) > 200 THEN 4 ELSE 5 END AS conciseness,
         array_to_string(list_filter([CASE WHEN {_refund} THEN {_q(replies.CLAIM_NOTES[0])} END,
           CASE WHEN {_action} THEN {_q(replies.CLAIM_NOTES[1])} END], lambda x: x IS NOT NULL), '|') AS claims FROM s4),
s6 AS (
  SELECT *, relevance + groundedness + factual_safety + actionability + tone + conciseness AS total_score,
         factual_safety >= 4 AS is_factually_safe,
         CASE WHEN intent = human_intent THEN 5 WHEN human_intent IN {base.sql_list(packs.TAXONOMY.labels)} THEN 3 ELSE 2 END AS review_relevance,
         CASE WHEN coalesce(top_score, 0) >= 0.40 THEN 5 WHEN coalesce(top_score, 0) >= 0.28 THEN 4 ELSE 3 END AS review_groundedness,
         5 AS review_factual_safety, CASE WHEN {_any("lo", ["dm", "orders"])} THEN 5 ELSE 4 END AS review_actionability,
         5 AS review_tone, 5 AS review_conciseness FROM s5),
scored AS (SELECT *, review_relevance + review_groundedness + review_actionability + 15 AS review_total_score FROM s6)"""


SCORED = f"""
{base.MSG},
s0 AS (
  SELECT m.tweet_id, m.component_id, m.text, o.text AS reply, {base.sql_label(base.sql_first_match("m.text", base.PACK))} AS intent,
         round((m.tweet_id * 7) % 997 / 997.0::DOUBLE, 4) AS confidence, round((m.tweet_id * 13) % 311 / 1000.0::DOUBLE, 4) AS margin,
         CASE WHEN m.tweet_id % 11 > 0 THEN round((m.tweet_id * 17) % 991 / 991.0::DOUBLE, 4) END AS top_score,
         ['Easy', 'Medium', 'Hard'][m.tweet_id % 3 + 1] AS difficulty
  FROM msg m LEFT JOIN first_out o USING (component_id) WHERE m.inbound),
s1 AS (
  SELECT *, CASE WHEN tweet_id % 4 = 0 THEN {_list}[list_position({_list}, intent) % {len(_names)} + 1] ELSE intent END AS human_intent,
         '@cust ' || CASE WHEN tweet_id % 3 = 0 THEN 'ok ' || tweet_id ELSE coalesce(reply, '') END
           || CASE WHEN tweet_id % 5 = 0 THEN ' We have refunded you, please check. ^AB' ELSE ' -XY' END AS piece FROM s0),
{sql_scored("s1")}
"""

_line = _fill(packs.EVIDENCE_LINE, "'1'", "'case_' || component_id", _two("top_score"), "intent", "text", "piece")
_prompt = _fill(packs.PROMPT, "text", "intent", _two("confidence"), f"CASE WHEN top_score IS NULL THEN {_q(packs.NO_EVIDENCE)} ELSE {_line} END")

ORACLES = {
    "escalation_codes": f"""WITH {SCORED} SELECT tweet_id, array_to_string(codes, ',') AS codes, decision, reason,
        array_to_string(why, ' / ') AS reasons FROM scored""",
    "draft_reply": f"""WITH {SCORED} SELECT tweet_id, suggested_reply, top_score IS NOT NULL AS is_grounded,
        CASE WHEN top_score IS NULL THEN '' ELSE 'case_' || component_id END AS evidence_ids,
        CASE WHEN top_score IS NOT NULL THEN 'case_' || component_id END AS primary_case FROM scored""",
    "evidence_prompt": f"WITH {SCORED} SELECT tweet_id, md5({_prompt}) AS prompt_md5 FROM scored",
    "score_reply": f"""WITH {SCORED} SELECT tweet_id, {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in SCORES)},
        round(total_score / 6.0, 2) AS average_score, claims, is_factually_safe FROM scored""",
    "proxy_review": f"""WITH {SCORED} SELECT tweet_id, {", ".join(f"CAST(review_{c} AS BIGINT) AS review_{c}" for c in SCORES)},
        round(review_total_score / 6.0, 2) AS review_average_score FROM scored""",
}
