"""Evaluation of triage against a labelled benchmark."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions.rules import Taxonomy
from caseflow.operators import metrics, replies, retrieval, splits
from caseflow.plans import triage
from caseflow.session import materialize

SCORES = (
    "total_score", "average_score", "relevance", "groundedness", "factual_safety",
    "actionability", "tone", "conciseness",
)


def evaluate(
    golden: DataFrame, model: triage.Predictor, index: retrieval.Index, k: int = 3,
    published_scoring: bool = False, taxonomy: Taxonomy = packs.TAXONOMY,
) -> DataFrame:
    """One result row per benchmark row: prediction, decision, reply and rubric scores.

    ``published_scoring`` reads every first case's score as 0, as the published run did.
    """
    messages = golden.withColumn("q_id", F.col("golden_id"))
    triaged = triage.run(messages, model, index, k, taxonomy)
    score = F.when(F.col("top_score").isNotNull(), F.lit(0.0)) if published_scoring else None
    return materialize(replies.score_reply(triaged, evidence_score=score), "evaluated")


def result_table(evaluated: DataFrame) -> DataFrame:
    """The 23 per-row result columns."""
    first = F.try_element_at("evidence", F.lit(1))
    return evaluated.select(
        "golden_id", "text", "human_intent", "difficulty", "language_scope",
        F.col("intent").alias("predicted_intent"),
        F.col("confidence").alias("intent_confidence"),
        F.col("margin").alias("intent_margin"),
        "decision", "reason", "reason_codes", "suggested_reply",
        first["case_id"].alias("top_evidence_id"),
        F.coalesce("top_score", F.lit(0.0)).alias("top_evidence_score"),
        *[F.col(c).alias(f"judge_{c}") for c in SCORES],
        "is_factually_safe",
    )


def review_sample(
    evaluated: DataFrame, quotas: dict[str, int] = packs.REVIEW_QUOTAS, seed: int = splits.SEED,
    taxonomy: Taxonomy = packs.TAXONOMY,
) -> DataFrame:
    """Rows per difficulty with the rule-made second rating."""
    chosen = splits.quota_sample(evaluated, "difficulty", "golden_id", quotas, seed).drop("rank")
    return replies.proxy_review_scores(chosen, taxonomy=taxonomy)


def headline(evaluated: DataFrame, quotas: dict[str, int] = packs.REVIEW_QUOTAS, taxonomy: Taxonomy = packs.TAXONOMY) -> DataFrame:
    """One row: intent scores, decision rates, escalation scores, reply quality, agreement."""
    inside = metrics.classification(
        evaluated.where(taxonomy.in_scope(F.col("human_intent"))), "human_intent", "intent"
    ).select("n", "accuracy", "macro_f1", "weighted_f1")
    rates = metrics.decision_rates(evaluated)
    needed = metrics.requires_escalation(F.col("human_intent"), F.col("difficulty"), taxonomy)
    escalation = metrics.binary_scores(evaluated, needed, F.col("decision") == "ESCALATE")
    quality = metrics.reply_quality(evaluated).select("mean_total_score", "safe_pct")
    agree = metrics.agreement(review_sample(evaluated, quotas, taxonomy=taxonomy), "review_total_score", "total_score")
    parts = [rates, inside, escalation, quality, agree.select(F.struct("*").alias("judge_agreement"))]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    joined = stacked.agg(*[F.first(c, ignorenulls=True).alias(c) for c in stacked.columns])  # every part is one row
    return joined.select(
        F.col("total").alias("golden_set_total"),
        F.col("n").alias("in_scope_count"),
        F.col("accuracy").alias("intent_accuracy"),
        F.col("macro_f1").alias("intent_macro_f1"),
        F.col("weighted_f1").alias("intent_weighted_f1"),
        "auto_handle_rate_pct", "escalation_rate_pct",
        F.col("recall").alias("escalation_safety_recall"),
        F.col("precision").alias("escalation_precision"),
        F.col("f1").alias("escalation_f1"),
        F.round("mean_total_score", 2).alias("mean_judge_score_out_of_30"),
        F.col("safe_pct").alias("judge_factual_safety_pass_rate_pct"),
        "judge_agreement",
    )
