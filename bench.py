"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from caseflow.functions import text as t  # noqa: E402
from caseflow.operators import conversations as conv  # noqa: E402
from caseflow.operators import retrieval  # noqa: E402
from caseflow.operators.models import IntentClassifier  # noqa: E402
from caseflow.plans.queries import QUERIES, base  # noqa: E402
from caseflow.session import local_session, materialize  # noqa: E402

HEADLINE = (
    "duplicate_rows", "brand_profile", "reply_components", "build_conversations", "clean_text", "tag_first_match",
    "rule_overlap", "orders_split", "quota_sample", "document_terms", "char_tfidf", "document_vocabulary",
    "hybrid_topk", "retrieval_metrics", "score_reply", "order_agreement", "triage_messages",
)


def fits(spark, sf_dir: str) -> dict[str, dict[str, float]]:
    """Fits alone, with the rows fitted: an index of resolved cases, one of documents, and the intent classifier."""
    stored, assignment = base.assigned(spark, sf_dir)
    pairs = materialize(conv.resolution_pairs(stored, assignment), "bench")
    first = materialize(conv.labelled_first_messages(stored, assignment, conv.TRAIN_SPLIT), "bench")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text IS NOT NULL").select(
        t.case_id(F.col("doc_id")).alias("case_id"), F.col("doc_id").alias("component_id"), F.col("text").alias("customer_text"),
        t.clean(F.col("text")).alias("cleaned_customer_text"), F.lit("").alias("agent_reply"), F.col("lang").alias("intent"))
    docs = materialize(docs, "bench")
    work = {
        "index_fit": (pairs, lambda: retrieval.fit_index(pairs)),
        "index_fit_documents": (docs, lambda: retrieval.fit_index(docs)),
        "classifier_fit": (first, lambda: IntentClassifier().fit(first, "component_id", "text", "intent")),
    }
    found = {}
    for name, (rows, fit) in work.items():
        n, start = rows.count(), time.perf_counter()
        fit()
        sec = time.perf_counter() - start
        found[name] = {"sec": round(sec, 3), "rows": n, "rows_per_sec": round(n / sec, 1)}
        print(name, found[name], file=sys.stderr, flush=True)
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before the clock
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.mode("overwrite").format("noop").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_wall_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "fits": fits(spark, sf_dir), "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
