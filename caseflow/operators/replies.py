"""Escalation gate, drafted replies, prompts and the reply rubric: column logic only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions import text as t
from caseflow.functions.rules import Taxonomy
from caseflow.operators.tagging import gate_flags

# Gate thresholds.
MIN_CONFIDENCE = 0.52
MIN_MARGIN = 0.08
MIN_SCORE = 0.28

# Shortest reply worth reusing, and an opening that is not reused.
MIN_REUSED = 20
NOT_REUSED = "sorry to hear that you have"


def decide(
    df: DataFrame,
    text: str = "text",
    intent: str = "intent",
    confidence: str = "confidence",
    margin: str = "margin",
    top_score: str = "top_score",
    known_non_english: str | None = None,
    min_confidence: float = MIN_CONFIDENCE,
    min_margin: float = MIN_MARGIN,
    min_score: float = MIN_SCORE,
    taxonomy: Taxonomy = packs.TAXONOMY,
) -> DataFrame:
    """Adds ``reason_codes, reasons, decision, reason``.

    ``top_score`` is the first case's rounded score, null where there is no case.
    """
    flags = gate_flags(F.col(text), F.col(known_non_english) if known_non_english else None)
    sure, gap, score, label = F.col(confidence), F.col(margin), F.col(top_score), F.col(intent)
    two = lambda c: F.format_number(c.cast("double"), 2)
    low_sure = sure < min_confidence
    limit = lambda x: F.lit(f"{x:.2f}")
    checks: dict[str, tuple[Column, tuple[Column, ...]]] = {
        "UNSUPPORTED_LANGUAGE": (flags["unsupported_language"], ()),
        "EXPLICIT_HUMAN_REQUEST": (flags["human_request"], ()),
        "HIGH_RISK_INTENT": (taxonomy.risky(label), (label,)),
        "OUT_OF_SCOPE_INTENT": (~taxonomy.in_scope(label), ()),
        "LOW_INTENT_CONFIDENCE": (low_sure, (two(sure), limit(min_confidence))),
        "AMBIGUOUS_INTENT_MARGIN": (~low_sure & (gap < min_margin), (two(gap),)),
        "NO_HISTORICAL_EVIDENCE": (score.isNull(), ()),
        "LOW_RETRIEVAL_CONFIDENCE": (score.isNotNull() & (score < min_score), (two(score), limit(min_score))),
    }
    codes = F.array_compact(F.array(*[F.when(hit, F.lit(code)) for code, (hit, _) in checks.items()]))
    texts = F.array_compact(F.array(*[
        F.when(hit, t.fill(packs.GATE_REASONS[code], *values)) for code, (hit, values) in checks.items()
    ]))
    all_clear = t.fill(packs.GATE_CLEAR, two(sure), two(score))
    escalate = F.size("reason_codes") > 0
    return (
        df.withColumn("reason_codes", codes).withColumn("reasons", texts)
        .withColumn("decision", F.when(escalate, "ESCALATE").otherwise("AUTO_HANDLE"))
        .withColumn("reason", F.when(escalate, F.try_element_at("reasons", F.lit(1))).otherwise(all_clear))
    )


def draft_reply(
    df: DataFrame,
    intent: str = "intent",
    evidence: str = "evidence",
    templates: dict[str, str] | None = None,
    default: str = packs.REPLY_DEFAULT,
    nothing_found: str = packs.REPLY_NO_EVIDENCE,
) -> DataFrame:
    """Adds ``suggested_reply, is_grounded, evidence_ids, primary_case``.

    ``evidence`` is an array of structs in rank order with ``case_id`` and ``agent_reply``.
    """
    templates = packs.REPLY_TEMPLATES if templates is None else templates
    found = F.coalesce(F.size(evidence) > 0, F.lit(False))
    first = F.try_element_at(evidence, F.lit(1))
    scrubbed = F.coalesce(t.scrub_reply(first["agent_reply"]), F.lit(""))
    reusable = (F.length(scrubbed) >= MIN_REUSED) & ~F.lower(scrubbed).startswith(NOT_REUSED)
    template = F.coalesce(*[F.when(F.col(intent) == k, F.lit(v)) for k, v in templates.items()], F.lit(default))
    return (
        df.withColumn("suggested_reply",
                      F.when(~found, nothing_found).when(reusable, scrubbed).otherwise(template))
        .withColumn("is_grounded", found)
        .withColumn("evidence_ids", F.when(found, F.slice(F.col(evidence)["case_id"], 1, 3))
                    .otherwise(F.array().cast("array<string>")))
        .withColumn("primary_case", F.when(found, first["case_id"]))
    )


def evidence_text(evidence: Column) -> Column:
    """Ranked cases as a block of text for a model outside this system."""
    lines = F.transform(evidence, lambda e, i: t.fill(
        packs.EVIDENCE_LINE, (i + 1).cast("string"), e["case_id"], F.format_number(e["similarity_score"].cast("double"), 2),
        e["intent"], e["historical_customer_text"], e["historical_agent_reply"],
    ))
    return F.when(F.size(evidence) > 0, F.array_join(lines, "\n\n")).otherwise(packs.NO_EVIDENCE)


def evidence_prompt(
    df: DataFrame, text: str = "text", intent: str = "intent", confidence: str = "confidence", evidence: str = "evidence"
) -> DataFrame:
    """Adds ``prompt``: message, intent and cases."""
    sure = F.format_number(F.col(confidence).cast("double"), 2)
    return df.withColumn("prompt", t.fill(packs.PROMPT, F.col(text), F.col(intent), sure, evidence_text(F.col(evidence))))


# The rubric's words, marks and limits.
CLAIMED_REFUND = ["refund has been issued", "we have refunded"]
CLAIMED_ACTION = ["we have cancelled your order", "your package has been re-sent"]
CLAIM_NOTES = (
    "Claimed refund was issued without account verification.",
    "Claimed order action was completed without tool access.",
)
RELEVANT_WORDS = {
    "Delivery Issue": ["delivery", "track", "order"],
    "Refund Request": ["refund", "order", "dm"],
    "Return / Wrong or Damaged Item": ["return", "replace", "damaged", "dm"],
    "Account Access / Security": ["security", "verify", "service", "dm"],
}
ACTION_WORDS = ["dm", "orders", "check", "visit", "contact"]
KIND_WORDS = ["sorry", "glad", "help", "please"]


def score_reply(
    df: DataFrame,
    reply: str = "suggested_reply",
    intent: str = "intent",
    evidence_score: Column | None = None,
    has_evidence: Column | None = None,
) -> DataFrame:
    """Adds six 1-to-5 scores, their total and mean, the claims and ``is_factually_safe``.

    ``evidence_score`` is the first case's score. The published run read a field that did
    not exist; ``lit(0.0)`` with ``has_evidence`` repeats it.
    """
    text, lower = F.col(reply), F.lower(F.col(reply))
    score = F.col("top_score") if evidence_score is None else evidence_score
    found = score.isNotNull() if has_evidence is None else has_evidence
    refund, action = t.contains_any(lower, CLAIMED_REFUND), t.contains_any(lower, CLAIMED_ACTION)
    relevance = F.when(F.length(text) < 15, 2)
    for label, needles in RELEVANT_WORDS.items():
        relevance = relevance.when((F.col(intent) == label) & t.contains_any(lower, needles), 5)
    size = F.length(text)
    parts = {
        "relevance": relevance.otherwise(4),
        "groundedness": F.when(~found, 3).when(refund | action, 1).when(score < 0.30, 3)
        .when(score > 0.45, 5).otherwise(4),
        "factual_safety": F.when(refund | action, 1).otherwise(5),
        "actionability": F.when(t.contains_any(lower, ACTION_WORDS), 5).otherwise(3),
        "tone": F.when(t.contains_any(lower, KIND_WORDS), 5).otherwise(4),
        "conciseness": F.when(size > 280, 3).when(size > 200, 4).otherwise(5),
    }
    scored = df.withColumns(parts)
    total = F.col("relevance")
    for name in list(parts)[1:]:
        total = total + F.col(name)
    return scored.withColumns({
        "total_score": total,
        "average_score": F.round(total / 6.0, 2),
        "unsupported_claims": F.array_compact(F.array(
            F.when(refund, CLAIM_NOTES[0]), F.when(action, CLAIM_NOTES[1]))),
        "is_factually_safe": F.col("factual_safety") >= 4,
    })


def proxy_review_scores(
    df: DataFrame, truth: str = "human_intent", predicted: str = "intent", score: str = "top_score",
    reply: str = "suggested_reply", taxonomy: Taxonomy = packs.TAXONOMY,
) -> DataFrame:
    """Adds a second, rule-made rating (``review_*``); it is not a person's opinion."""
    lower, top = F.lower(F.col(reply)), F.coalesce(F.col(score), F.lit(0.0))
    parts = {
        "review_relevance": F.when(F.col(predicted) == F.col(truth), 5)
        .when(taxonomy.in_scope(F.col(truth)), 3).otherwise(2),
        "review_groundedness": F.when(top >= 0.40, 5).when(top >= 0.28, 4).otherwise(3),
        "review_factual_safety": F.lit(5),
        "review_actionability": F.when(t.contains_any(lower, ["dm", "orders"]), 5).otherwise(4),
        "review_tone": F.lit(5),
        "review_conciseness": F.lit(5),
    }
    rated = df.withColumns(parts)
    total = F.col("review_relevance")
    for name in list(parts)[1:]:
        total = total + F.col(name)
    return rated.withColumn("review_total_score", total).withColumn(
        "review_average_score", F.round(total / 6.0, 2))
