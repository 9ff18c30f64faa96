"""Classification, decision, quality and agreement measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.operators import conversations as conv
from caseflow.operators import metrics
from caseflow.operators import replies as rp
from caseflow.operators import retrieval, splits
from caseflow.operators.models import MajorityBaseline, RuleClassifier
from caseflow.plans import evaluation
from caseflow.plans.queries import base, search
from caseflow.plans.queries import replies as scored
from caseflow.plans.queries import splits as labels
from caseflow.session import materialize
from caseflow.sources import standin

LABELS = list(packs.TAXONOMY.labels)


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored.scored_messages(spark, sf_dir)
    return metrics.classification(rows, "human_intent", "intent")


def per_class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.per_class_report(scored.scored_messages(spark, sf_dir), "human_intent", "intent", LABELS)


def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(scored.scored_messages(spark, sf_dir), "human_intent", "intent", LABELS)


def in_scope_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.in_scope_report(scored.scored_messages(spark, sf_dir), "human_intent", "intent")


def scope_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.scope_totals(scored.scored_messages(spark, sf_dir), "human_intent")


def order_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two guesses of an order's priority, compared as models over the whole table."""
    orders = standin.table(spark, sf_dir, "orders")
    names = F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")])
    by_customer = F.element_at(names, (F.col("o_custkey") % 5 + 1).cast("int"))
    by_price = F.element_at(names, (F.floor(F.col("o_totalprice")) % 5 + 1).cast("int"))
    return metrics.compare_models(
        {"by_customer": orders.withColumn("guess", by_customer), "by_price": orders.withColumn("guess", by_price)},
        "o_orderpriority", "guess")


def decision_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.decision_rates(rp.decide(scored.scored_messages(spark, sf_dir)))


def escalation_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = rp.decide(scored.scored_messages(spark, sf_dir))
    needed = metrics.requires_escalation(F.col("human_intent"), F.col("difficulty"))
    return metrics.binary_scores(decided, needed, F.col("decision") == "ESCALATE")


def reply_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.reply_quality(scored.full(spark, sf_dir))


def review_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored.scored_messages(spark, sf_dir)
    return splits.quota_sample(rows, "difficulty", "tweet_id", packs.REVIEW_QUOTAS).select("tweet_id", "difficulty", "rank")


def agreement_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = materialize(rp.proxy_review_scores(scored.full(spark, sf_dir)).select(
        "review_total_score", "total_score", "difficulty"), "rated")
    return metrics.agreement(rated, "review_total_score", "total_score", ("difficulty",))


def order_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two derived 0-to-40 ratings per order line, as one overall comparison."""
    lines = standin.table(spark, sf_dir, "lineitem").select(
        (F.col("l_quantity").cast("bigint") % 41).alias("a"), ((F.col("l_quantity").cast("bigint") + F.col("l_linenumber")) % 41).alias("b"))
    return metrics.agreement(lines, "a", "b")


def _benchmark(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Stored messages, their assignment, and labelled benchmark rows: none of them is in the training split."""
    stored, assignment = base.assigned(spark, sf_dir)
    golden = materialize(splits.build_golden_set(stored, assignment, base.PACK), "golden")
    return stored, assignment, materialize(splits.apply_labels(golden, labels._labels(golden)), "labelled")


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, assignment, labelled = _benchmark(spark, sf_dir)
    index = retrieval.fit_index(conv.resolution_pairs(stored, assignment))
    return evaluation.evaluate(labelled, RuleClassifier(base.PACK), index)


def evaluation_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage of the labelled benchmark with intents by rules, one row of results a message."""
    table = evaluation.result_table(_evaluated(spark, sf_dir))
    return table.withColumns({
        "text": F.md5("text"), "suggested_reply": F.md5("suggested_reply"), "reason_codes": F.array_join("reason_codes", ","),
        **{f"judge_{c}": F.col(f"judge_{c}").cast("double") for c in evaluation.SCORES},
    })


def headline_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one row of headline measures of the same run."""
    row = evaluation.headline(_evaluated(spark, sf_dir))
    return row.select(*[c for c in row.columns if c != "judge_agreement"], "judge_agreement.*")


def golden_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent training label and the rules, compared on the labelled benchmark."""
    stored, assignment, labelled = _benchmark(spark, sf_dir)
    train = conv.labelled_first_messages(stored, assignment, conv.TRAIN_SPLIT)
    rows = labelled.select("golden_id", "text", "human_intent")
    models = {
        "majority": MajorityBaseline().fit(train, "intent").transform(rows),
        "rules": RuleClassifier(base.PACK).transform(rows, "golden_id", "text"),
    }
    return metrics.compare_models(models, "human_intent")


def golden_retrieval_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search for the labelled benchmark, none of whose components is in the index; the bonus goes by the predicted intent."""
    stored, assignment, labelled = _benchmark(spark, sf_dir)
    index = retrieval.fit_index(conv.resolution_pairs(stored, assignment))
    told = RuleClassifier(base.PACK).transform(labelled.withColumn("q_id", F.col("golden_id")), "q_id", "text")
    asked = materialize(told.select("q_id", "text", "human_intent", F.col("intent").alias("predicted_intent")), "asked")
    return retrieval.evaluate_retrieval(asked, index, "human_intent")


QUERIES = {f.__name__: f for f in (
    classification_metrics, per_class_report, confusion_matrix, in_scope_report, scope_totals, order_model_scores,
    decision_rates, escalation_scores, reply_quality, review_sample, agreement_stats, order_agreement,
    evaluation_rules, headline_rules, golden_model_scores, golden_retrieval_metrics,
)}


def _per_label(source: str, truth: str, pred: str, by: str = "'all'") -> str:
    return f"""
pr AS (SELECT {by} AS grp, {truth} AS y, {pred} AS p, count(*) AS n FROM {source} GROUP BY 1, 2, 3),
lb AS (SELECT DISTINCT grp, y AS label FROM pr UNION SELECT DISTINCT grp, p FROM pr),
pl AS (SELECT l.grp, l.label, coalesce(sum(n) FILTER (y = label AND p = label), 0) AS tp,
       coalesce(sum(n) FILTER (y <> label AND p = label), 0) AS fp, coalesce(sum(n) FILTER (y = label AND p <> label), 0) AS fn
       FROM lb l JOIN pr ON pr.grp = l.grp AND (y = label OR p = label) GROUP BY 1, 2),
pm AS (SELECT *, tp + fn AS support, coalesce(tp / nullif(tp + fp, 0), 0) AS pre, coalesce(tp / nullif(tp + fn, 0), 0) AS rec,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM pl)"""


_MACRO = """CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 4) AS accuracy, round(avg(f1), 4) AS macro_f1,
  round(sum(f1 * support) / sum(support), 4) AS weighted_f1, round(avg(pre), 4) AS macro_precision, round(avg(rec), 4) AS macro_recall"""
_inside = f"human_intent IN {base.sql_list(LABELS)}"
_needed = f"(NOT {_inside} OR human_intent IN {base.sql_list(packs.TAXONOMY.high_risk)} OR difficulty = 'Hard')"
_values = ", ".join(f"('{x}', {i})" for i, x in enumerate(LABELS))


def _agreement(source: str, a: str, b: str, by: str, output: str) -> str:
    return f"""
ag AS (SELECT {by} AS grp, CAST({a} AS DOUBLE) AS a, CAST({b} AS DOUBLE) AS b FROM {source}),
rk AS (SELECT *, rank() OVER (PARTITION BY grp ORDER BY a) + (count(*) OVER (PARTITION BY grp, a) - 1) / 2.0 AS ra,
       rank() OVER (PARTITION BY grp ORDER BY b) + (count(*) OVER (PARTITION BY grp, b) - 1) / 2.0 AS rb FROM ag)
SELECT {output} count(*) AS sample_size, round(100.0 * count(*) FILTER (a = b) / count(*), 2) AS exact_agreement_pct,
  round(100.0 * count(*) FILTER (abs(a - b) <= 1) / count(*), 2) AS within_1_pct,
  round(100.0 * count(*) FILTER (abs(a - b) <= 2) / count(*), 2) AS within_2_pct, round(avg(abs(a - b)), 4) AS mean_absolute_error,
  CASE WHEN min(a) < max(a) AND min(b) < max(b) THEN round(corr(a, b), 4) ELSE 1.0 END AS pearson,
  CASE WHEN min(a) < max(a) AND min(b) < max(b) THEN round(corr(ra, rb), 4) ELSE 1.0 END AS spearman
FROM rk GROUP BY grp"""


ORACLES = {
    "classification_metrics": f"WITH {scored.SCORED}, {_per_label('scored', 'human_intent', 'intent')} SELECT {_MACRO} FROM pm",
    "per_class_report": f"""WITH {scored.SCORED}, {_per_label('scored', 'human_intent', 'intent')}
        SELECT v.label, round(coalesce(pre, 0), 4) AS precision, round(coalesce(rec, 0), 4) AS recall, round(coalesce(f1, 0), 4) AS f1,
        CAST(coalesce(support, 0) AS BIGINT) AS support FROM (VALUES {_values}) v(label, i) LEFT JOIN pm ON pm.label = v.label""",
    "confusion_matrix": f"""WITH {scored.SCORED} SELECT v.label, {", ".join(
        f'''count(*) FILTER (s.intent = '{x}') AS "{x}"''' for x in LABELS)}
        FROM (VALUES {_values}) v(label, i) LEFT JOIN scored s ON s.human_intent = v.label GROUP BY 1""",
    "in_scope_report": f"""WITH {scored.SCORED}, t AS (SELECT human_intent, intent, unnest(['All', difficulty]) AS tier FROM scored WHERE {_inside}),
        {_per_label('t', 'human_intent', 'intent', 'tier')} SELECT grp AS tier, {_MACRO} FROM pm GROUP BY 1""",
    "scope_totals": f"""WITH {scored.SCORED} SELECT count(*) AS total, count(*) FILTER ({_inside}) AS in_scope,
        count(*) FILTER (NOT {_inside}) AS out_of_scope FROM scored""",
    "order_model_scores": f"""WITH nm AS (SELECT ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'] AS l),
        g AS (SELECT 'by_customer' AS model, o_orderpriority AS y0, l[o_custkey % 5 + 1] AS p0 FROM orders, nm
              UNION ALL SELECT 'by_price', o_orderpriority, l[CAST(floor(o_totalprice) AS BIGINT) % 5 + 1] FROM orders, nm),
        {_per_label('g', 'y0', 'p0', 'model')} SELECT grp AS model, {_MACRO} FROM pm GROUP BY 1""",
    "decision_rates": f"""WITH {scored.SCORED} SELECT count(*) AS total,
        round(100.0 * count(*) FILTER (decision = 'ESCALATE') / count(*), 2) AS escalation_rate_pct,
        round(100.0 * count(*) FILTER (decision = 'AUTO_HANDLE') / count(*), 2) AS auto_handle_rate_pct FROM scored""",
    "escalation_scores": f"""WITH {scored.SCORED}, x AS (SELECT count(*) FILTER ({_needed} AND decision = 'ESCALATE') AS tp,
        count(*) FILTER (NOT {_needed} AND decision = 'ESCALATE') AS fp, count(*) FILTER ({_needed} AND decision <> 'ESCALATE') AS fn FROM scored)
        SELECT round(tp / (tp + fp), 4) AS precision, round(tp / (tp + fn), 4) AS recall, round(2 * tp / (2 * tp + fp + fn), 4) AS f1 FROM x""",
    "reply_quality": f"""WITH {scored.SCORED} SELECT count(*) AS replies, {", ".join(
        f"round(avg({c}), 4) AS mean_{c}" for c in metrics.RUBRIC)},
        coalesce(round(100.0 * count(*) FILTER (is_factually_safe) / nullif(count(*), 0), 2), 0) AS safe_pct
        FROM scored WHERE decision = 'AUTO_HANDLE'""",
    "review_sample": f"""WITH {base.MSG}, d AS (SELECT tweet_id, ['Easy', 'Medium', 'Hard'][tweet_id % 3 + 1] AS difficulty FROM msg WHERE inbound),
        r AS (SELECT *, row_number() OVER (PARTITION BY difficulty ORDER BY md5('{base.SEED}:' || tweet_id), tweet_id) AS rank FROM d)
        SELECT tweet_id, difficulty, CAST(rank AS INT) AS rank FROM r
        JOIN (VALUES ('Easy', 20), ('Medium', 14), ('Hard', 6)) v(k, q) ON k = difficulty WHERE rank <= q""",
    "agreement_stats": f"WITH {scored.SCORED}, {_agreement('scored', 'review_total_score', 'total_score', 'difficulty', 'grp AS difficulty,')}",
    "order_agreement": "WITH " + _agreement("lineitem", "CAST(l_quantity AS BIGINT) % 41", "(CAST(l_quantity AS BIGINT) + l_linenumber) % 41", "0", ""),
}

_rule = base.sql_label(base.sql_first_match("g.text", base.PACK))
_hits = base.sql_hit_count("g.text", base.PACK)
_ASKED = f"""
{labels._LABELLED},{base.SQL_CORPUS},
told AS (SELECT g.golden_id, g.text, l.human_intent, l.difficulty, l.language_scope, {_rule} AS intent,
                CASE WHEN {_hits} > 0 THEN round(1.0::DOUBLE / {_hits}, 4) ELSE 0.0 END AS confidence,
                CASE WHEN {_hits} = 1 THEN 1.0::DOUBLE ELSE 0.0 END AS margin
         FROM golden g JOIN labelled l USING (golden_id)),
{search.sql_found(f"queries AS (SELECT golden_id AS q_id, {base.sql_clean('text')} AS text, intent AS gold FROM told WHERE {base.sql_clean('text')} <> '')")}"""
_EVALUATED = f"""{_ASKED},
{search.sql_search(search.SAME, 3)},
e1 AS (SELECT t.*, b.case_id, b.score AS top_score, c.agent_reply AS piece FROM told t
       LEFT JOIN best b ON b.q_id = t.golden_id AND b.rank = 1 LEFT JOIN corpus c ON c.case_id = b.case_id),
{scored.sql_scored("e1")}"""
_safe = "round(100.0 * count(*) FILTER (is_factually_safe) / nullif(count(*), 0), 2)"

ORACLES |= {
    "evaluation_rules": f"""WITH {_EVALUATED} SELECT golden_id, md5(text) AS text, human_intent, difficulty, language_scope,
        intent AS predicted_intent, confidence AS intent_confidence, margin AS intent_margin, decision, reason,
        array_to_string(codes, ',') AS reason_codes, md5(suggested_reply) AS suggested_reply, case_id AS top_evidence_id,
        coalesce(top_score, 0) AS top_evidence_score, {", ".join(f"CAST({c} AS DOUBLE) AS judge_{c}" for c in evaluation.SCORES if c != "average_score")},
        round(total_score / 6.0, 2) AS judge_average_score, is_factually_safe FROM scored""",
    "headline_rules": f"""WITH {_EVALUATED}, inside AS (SELECT * FROM scored WHERE {_inside}), {_per_label('inside', 'human_intent', 'intent')},
        m AS (SELECT {_MACRO} FROM pm),
        d AS (SELECT count(*) AS total, round(100.0 * count(*) FILTER (decision = 'AUTO_HANDLE') / count(*), 2) AS auto_pct,
              round(100.0 * count(*) FILTER (decision = 'ESCALATE') / count(*), 2) AS escalated_pct,
              count(*) FILTER ({_needed} AND decision = 'ESCALATE') AS tp, count(*) FILTER (NOT {_needed} AND decision = 'ESCALATE') AS fp,
              count(*) FILTER ({_needed} AND decision <> 'ESCALATE') AS fn FROM scored),
        h AS (SELECT round(round(avg(total_score), 4), 2) AS mean_score, coalesce({_safe}, 0) AS safe FROM scored WHERE decision = 'AUTO_HANDLE'),
        rs AS (SELECT *, row_number() OVER (PARTITION BY difficulty ORDER BY md5('{base.SEED}:' || golden_id), golden_id) AS place FROM scored),
        rv AS (SELECT * FROM rs JOIN (VALUES {", ".join(f"('{k}', {v})" for k, v in packs.REVIEW_QUOTAS.items())}) v(tier, quota) ON tier = difficulty WHERE place <= quota),
        a AS (WITH {_agreement("rv", "review_total_score", "total_score", "0", "")})
        SELECT total AS golden_set_total, n AS in_scope_count, accuracy AS intent_accuracy, macro_f1 AS intent_macro_f1, weighted_f1 AS intent_weighted_f1,
        auto_pct AS auto_handle_rate_pct, escalated_pct AS escalation_rate_pct, round(coalesce(tp / nullif(tp + fn, 0), 0), 4) AS escalation_safety_recall,
        round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS escalation_precision, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 4) AS escalation_f1,
        mean_score AS mean_judge_score_out_of_30, safe AS judge_factual_safety_pass_rate_pct, a.* FROM m, d, h, a""",
    "golden_model_scores": f"""WITH {labels._LABELLED},
        top_ AS (SELECT {base.sql_label("s.heuristic_intent")} AS label FROM tagged t JOIN assignment s USING (component_id)
                 WHERE s.split = 'train_retrieval' AND s.heuristic_intent NOT IN ('unmatched_other', 'non_english_out_of_scope')
                 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
        guess AS (SELECT 'majority' AS model, l.human_intent, label AS intent FROM labelled l, top_ UNION ALL
                  SELECT 'rules', l.human_intent, {_rule} FROM golden g JOIN labelled l USING (golden_id)),
        {_per_label('guess', 'human_intent', 'intent', 'model')} SELECT grp AS model, {_MACRO} FROM pm GROUP BY 1""",
    "golden_retrieval_metrics": "WITH " + _ASKED + f""", {search.sql_search(search.SAME, 5, "b5")},
        all_q AS (SELECT golden_id AS q_id, human_intent AS gold FROM told)
        SELECT * EXCLUDE (condition_on) FROM ({search._metrics("b5", "predicted")})""",
}
