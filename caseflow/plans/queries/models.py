"""Classifiers, topic clusters and triage with a fitted model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.operators import clustering, metrics, retrieval, splits
from caseflow.operators import conversations as conv
from caseflow.operators.models import IntentClassifier, IntentModel, MajorityBaseline, RuleClassifier, TfidfLogisticBaseline
from caseflow.operators.stages import IntentEstimator
from caseflow.plans import evaluation, triage
from caseflow.plans.queries import base, replies, search
from caseflow.session import materialize, scratch_path
from caseflow.sources import standin
from caseflow.streaming import triage as streaming


def _documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents split by language: the training part, and the rest to score."""
    docs = standin.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    split = materialize(splits.stratified_split(docs.select("doc_id", "lang"), "doc_id", "lang"), "split")
    rows = docs.join(split.select("doc_id", "split"), "doc_id")
    return rows.where(F.col("split") == conv.TRAIN_SPLIT), rows.where(F.col("split") != conv.TRAIN_SPLIT)


def majority_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, rest = _documents(spark, sf_dir)
    return MajorityBaseline().fit(train, "lang").transform(rest).select(
        "doc_id", "lang", "intent", F.col("probabilities")[F.col("intent")].alias("confidence"))


def logistic_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, rest = _documents(spark, sf_dir)
    model = TfidfLogisticBaseline().fit(train, "doc_id", "text", "lang")
    return model.transform(rest, "doc_id", "text").select("doc_id", "lang", "intent")


def intent_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, rest = _documents(spark, sf_dir)
    model = IntentClassifier().fit(train, "doc_id", "text", "lang")
    return model.transform(rest, "doc_id", "text").select(
        "doc_id", "lang", "intent", "confidence", "margin", "is_confident")


def _messages(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, IntentModel]:
    stored, assignment = base.assigned(spark, sf_dir)
    train = conv.labelled_first_messages(stored, assignment, conv.TRAIN_SPLIT)
    model = IntentClassifier().fit(train, "component_id", "text", "intent")
    return stored, assignment, train, model


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, assignment, train, model = _messages(spark, sf_dir)
    valid = materialize(conv.labelled_first_messages(stored, assignment, "validation").select(
        "component_id", "text", F.col("intent").alias("truth")), "validation")
    simple = TfidfLogisticBaseline().fit(train.select("component_id", "text", "intent"), "component_id", "text", "intent")
    scored = {
        "majority": MajorityBaseline().fit(train, "intent").transform(valid),
        "tfidf_logistic": simple.transform(valid, "component_id", "text"),
        "calibrated": model.transform(valid, "component_id", "text"),
    }
    return metrics.compare_models(scored, "truth")


# The solver's tolerance leaves up to 0.0003 on the message table; coefficients of another objective are beyond this bound (tests).
GRADIENT_BOUND = 1e-3


def classifier_certificate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each fold's coefficients are at the optimum, and answers that break a rule of probabilities."""
    stored, _, train, model = _messages(spark, sf_dir)
    proof = IntentClassifier().certificate(model, train, "component_id", "text", "intent")
    proof = proof.withColumn("at_optimum", F.col("largest_gradient") < GRADIENT_BOUND)
    rows = stored.where("inbound").select("tweet_id", "text")
    ranked = F.sort_array("chances", asc=False)
    told = materialize(model.predict_proba(rows, "tweet_id", "text").select("tweet_id", "chances"), "chances")
    shown = model.transform(rows, "tweet_id", "text").select("tweet_id", "confidence", "margin")
    total = F.aggregate("chances", F.lit(0.0), lambda a, x: a + x)
    wrong = told.join(shown, "tweet_id").agg(
        F.count("*").alias("answers"),
        F.count_if(F.abs(total - 1) > 1e-9).alias("wrong_sums"),
        F.count_if(F.abs(F.col("margin") - (ranked[0] - ranked[1])) > 6e-5).alias("wrong_margins"),
        F.count_if(F.abs(F.col("confidence") - ranked[0]) > 6e-5).alias("wrong_confidences"),
    ).first()
    return proof.select("fold", "at_optimum", *[F.lit(wrong[c]).alias(c) for c in ("answers", "wrong_sums", "wrong_margins", "wrong_confidences")])


def saved_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pipeline with the classifier, fitted, saved and loaded: its answers beside those of the fitted one."""
    stored, assignment = base.assigned(spark, sf_dir)
    train = conv.labelled_first_messages(stored, assignment, conv.TRAIN_SPLIT)
    stage = IntentEstimator(rowIdCol="tweet_id", textCol="text", labelCol="intent", folds=3, minConfidence=0.6)
    fitted = Pipeline(stages=[stage]).fit(train.select("tweet_id", "text", "intent"))
    path = scratch_path(spark, "pipeline")
    fitted.write().overwrite().save(path)
    rows, columns = stored.where("inbound").select("tweet_id", "text"), ["tweet_id", "intent", "confidence", "margin", "is_confident"]
    told = [materialize(m.transform(rows).select(*columns), "scores") for m in (fitted, PipelineModel.load(path))]
    both = told[0].join(told[1].select("tweet_id", F.struct(*columns[1:]).alias("loaded")), "tweet_id", "left")
    return both.select("tweet_id", F.struct(*columns[1:]).eqNullSafe(F.col("loaded")).alias("same"))


def topic_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = standin.table(spark, sf_dir, "documents")
    return clustering.fit_topics(docs, "doc_id", "text").summary()


def _triage_setting(spark: SparkSession, sf_dir: str):
    stored, assignment, _, model = _messages(spark, sf_dir)
    return stored, assignment, model, retrieval.fit_index(conv.resolution_pairs(stored, assignment))


def triage_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, _, model, index = _triage_setting(spark, sf_dir)
    queries = stored.where("inbound").select(F.col("tweet_id").alias("q_id"), "text")
    return triage.output(triage.run(queries, model, index))


def triage_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triage with intents by rules: classification, search, gates and replies in one result."""
    stored, assignment = base.assigned(spark, sf_dir)
    index = retrieval.fit_index(conv.resolution_pairs(stored, assignment))
    queries = stored.where("inbound").select(F.col("tweet_id").alias("q_id"), "text")
    done = triage.run(queries, RuleClassifier(base.PACK), index)
    return done.select(
        "q_id", "intent", "confidence", "margin", F.col("top_score").alias("top_score"), F.array_join("reason_codes", ",").alias("codes"),
        "decision", "reason", F.md5("suggested_reply").alias("reply_md5"), "is_grounded", F.array_join("evidence_ids", ",").alias("evidence_ids"))


def _streamed(spark: SparkSession, sf_dir: str, model, index) -> DataFrame:
    """The sink of a stream in which every customer message is sent twice."""
    path, sent = scratch_path(spark, "stream"), _stream(spark, sf_dir)
    done = streaming.run(
        sent.unionByName(sent).select(F.col("tweet_id").alias("q_id"), "text", "created_at"),
        model, index, f"{path}/out", f"{path}/state", available_now=True)
    done.awaitTermination()
    return spark.read.parquet(f"{path}/out")


def streaming_triage(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, model, index = _triage_setting(spark, sf_dir)
    return _streamed(spark, sf_dir, model, index).select("q_id", "intent", "decision", "suggested_reply")


def streaming_triage_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream with intents by rules: each message once, with the answer that the table gives."""
    stored, assignment = base.assigned(spark, sf_dir)
    index = retrieval.fit_index(conv.resolution_pairs(stored, assignment))
    return _streamed(spark, sf_dir, RuleClassifier(base.PACK), index).select(
        "q_id", "intent", F.col("intent_confidence").alias("confidence"), "decision", "reason", F.md5("suggested_reply").alias("reply_md5"),
        F.array_join(F.transform("evidence", lambda e: e["case_id"]), ",").alias("evidence_ids"))


def _stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = standin.table(spark, sf_dir, "conversations").schema
    # a file, or a folder of files; a plain path of a stream must be a folder, a pattern need not
    turns = spark.readStream.schema(schema).parquet(f"{sf_dir}/conversations[.]parquet")
    tweet_id = F.col("conv_id") * 1000 + F.col("turn")
    sent = F.timestamp_seconds(F.lit(standin.FIRST_SECOND) + tweet_id)
    return turns.where("role = 'user'").select(tweet_id.alias("tweet_id"), "text", sent.alias("created_at"))


def streaming_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "stream")
    query = (
        streaming.stateless(_stream(spark, sf_dir).drop("created_at"), base.PACK).writeStream.format("parquet")
        .option("checkpointLocation", f"{path}/state").option("path", f"{path}/out").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{path}/out").select(
        "tweet_id", "heuristic_intent", "cleaned_text", "unsupported_language", "human_request")


def _evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    from caseflow.plans.queries.splits import _labels

    stored, assignment, model, index = _triage_setting(spark, sf_dir)
    golden = materialize(splits.build_golden_set(stored, assignment, base.PACK), "golden")
    labelled = materialize(splits.apply_labels(golden, _labels(golden)), "labelled")
    return evaluation.evaluate(labelled, model, index)


def evaluation_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.result_table(_evaluated(spark, sf_dir))


def headline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.headline(_evaluated(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    majority_baseline, logistic_baseline, intent_classifier, classifier_certificate, saved_model_scores, model_comparison, topic_clusters, triage_messages, triage_rules,
    streaming_triage, streaming_triage_rules, streaming_gates, evaluation_results, headline_metrics,
)}

_gate = (
    f"({base.sql_match('text', packs.GATE_LANGUAGE)} OR regexp_matches(text, "
    r"'[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{0600}-\x{06ff}\x{0400}-\x{04ff}]'))"
)

_hits = base.sql_hit_count("m.text", base.PACK)

ORACLES = {
    "triage_rules": f"""WITH {search.FOUND}, {search.sql_search(search.SAME, 3)},
        t1 AS (SELECT m.tweet_id, m.text, {base.sql_label(base.sql_first_match("m.text", base.PACK))} AS intent,
               CASE WHEN {_hits} > 0 THEN round(1.0::DOUBLE / {_hits}, 4) ELSE 0 END AS confidence,
               CASE WHEN {_hits} = 1 THEN 1.0::DOUBLE ELSE 0 END AS margin, b.score AS top_score, c.agent_reply AS piece
               FROM msg m LEFT JOIN best b ON b.q_id = CAST(m.tweet_id AS VARCHAR) AND b.rank = 1 LEFT JOIN corpus c ON c.case_id = b.case_id
               WHERE m.inbound),
        ev AS (SELECT q_id, string_agg(case_id, ',' ORDER BY rank) AS ids FROM best GROUP BY 1),
        {replies.sql_decided("t1")[:-1]}
        SELECT CAST(tweet_id AS VARCHAR) AS q_id, intent, confidence, margin, top_score, array_to_string(codes, ',') AS codes, decision, reason,
               md5(suggested_reply) AS reply_md5, top_score IS NOT NULL AS is_grounded, coalesce(ids, '') AS evidence_ids
        FROM s3 LEFT JOIN ev ON q_id = CAST(tweet_id AS VARCHAR)""",
    "majority_baseline": f"""WITH strata AS (SELECT lang AS stratum, count(*) AS n FROM documents GROUP BY 1),
        {base.sql_quotas("strata")},
        p AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('{base.SEED}:' || doc_id), doc_id) AS k FROM documents)
        SELECT doc_id, lang, (SELECT stratum FROM quotas ORDER BY train DESC, stratum LIMIT 1) AS intent, 1.0::DOUBLE AS confidence
        FROM p JOIN quotas ON stratum = lang WHERE k > train""",
    "streaming_gates": f"""WITH {base.MSG} SELECT tweet_id,
        CASE WHEN {base.sql_match("text", packs.SPLIT_LANGUAGE)} THEN 'non_english_out_of_scope'
             ELSE {base.sql_first_match("text", base.PACK)} END AS heuristic_intent,
        {base.sql_clean("text")} AS cleaned_text, {_gate} AS unsupported_language,
        {base.sql_match("text", packs.GATE_HUMAN)} AS human_request FROM raw WHERE inbound""",
}

ORACLES["streaming_triage_rules"] = f"SELECT q_id, intent, confidence, decision, reason, reply_md5, evidence_ids FROM ({ORACLES['triage_rules']})"

ORACLES["classifier_certificate"] = f"""WITH {base.MSG} SELECT CAST(f.range AS INT) AS fold, true AS at_optimum, count(*) AS answers,
    0 AS wrong_sums, 0 AS wrong_margins, 0 AS wrong_confidences FROM msg, range(5) f WHERE inbound GROUP BY f.range"""
ORACLES["saved_model_scores"] = f"WITH {base.MSG} SELECT tweet_id, true AS same FROM msg WHERE inbound"
