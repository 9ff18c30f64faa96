import pytest
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.operators import metrics, replies


def gate(spark, text="where is it", intent="Delivery Issue", conf=0.9, margin=0.5, score=0.8):
    df = spark.createDataFrame([(text, intent, conf, margin, score)], "text string, intent string, confidence double, margin double, top_score double")
    return replies.decide(df).first()


@pytest.mark.parametrize("change, codes", [
    ({}, []),
    ({"text": "Hola, necesito ayuda con mi pedido por favor."}, ["UNSUPPORTED_LANGUAGE"]),
    ({"text": "I want a real person"}, ["EXPLICIT_HUMAN_REQUEST"]),
    ({"intent": "Account Access / Security"}, ["HIGH_RISK_INTENT"]),
    ({"intent": "Unauthorized / Non-Prime Charge"}, ["HIGH_RISK_INTENT"]),
    ({"intent": "Ambiguous"}, ["OUT_OF_SCOPE_INTENT"]),
    ({"conf": 0.5199}, ["LOW_INTENT_CONFIDENCE"]),
    ({"conf": 0.5199, "margin": 0.01}, ["LOW_INTENT_CONFIDENCE"]),
    ({"conf": 0.52}, []),
    ({"margin": 0.0799}, ["AMBIGUOUS_INTENT_MARGIN"]),
    ({"margin": 0.08}, []),
    ({"score": None}, ["NO_HISTORICAL_EVIDENCE"]),
    ({"score": 0.2799}, ["LOW_RETRIEVAL_CONFIDENCE"]),
    ({"score": 0.28}, []),
    ({"text": "gracias, live agent", "score": 0.1}, ["UNSUPPORTED_LANGUAGE", "EXPLICIT_HUMAN_REQUEST", "LOW_RETRIEVAL_CONFIDENCE"]),
])
def test_gate(spark, change, codes):
    row = gate(spark, **change)
    assert row.reason_codes == codes
    assert row.decision == ("ESCALATE" if codes else "AUTO_HANDLE")
    assert len(row.reasons) == len(codes)
    if codes:
        assert row.reason == row.reasons[0]
    else:
        assert row.reason.startswith("High intent confidence (0.")


def draft(spark, reply, intent="Refund Request"):
    df = spark.createDataFrame([(intent,)], "intent string")
    case = F.struct(F.lit("case_1").alias("case_id"), F.lit(reply).alias("agent_reply"))
    cases = F.array(case) if reply is not None else F.array().cast("array<struct<case_id:string,agent_reply:string>>")
    return replies.draft_reply(df.withColumn("evidence", cases)).first()


def test_drafts(spark):
    assert draft(spark, None).suggested_reply == packs.REPLY_NO_EVIDENCE and not draft(spark, None).is_grounded
    assert draft(spark, "@c " + "x" * 20 + " ^SJ").suggested_reply == "x" * 20
    assert draft(spark, "x" * 19).suggested_reply == packs.REPLY_TEMPLATES["Refund Request"]
    assert draft(spark, "Sorry to hear that you have waited so long").suggested_reply == packs.REPLY_TEMPLATES["Refund Request"]
    assert draft(spark, "short", "Ambiguous").suggested_reply == packs.REPLY_DEFAULT
    assert draft(spark, "x" * 30).evidence_ids == ["case_1"] and draft(spark, "x" * 30).primary_case == "case_1"


@pytest.mark.parametrize("reply, intent, score, want", [
    ("x" * 14, "Refund Request", 0.5, dict(relevance=2, groundedness=5, actionability=3, tone=4, conciseness=5)),
    ("x" * 15, "Refund Request", 0.45, dict(relevance=4, groundedness=4)),
    ("Your REFUND is on the way, sorry", "Refund Request", 0.30, dict(relevance=5, groundedness=4, tone=5)),
    ("Please check the delivery status", "Delivery Issue", 0.29, dict(relevance=5, groundedness=3, actionability=5)),
    ("We have refunded you in full", "Refund Request", 0.9, dict(groundedness=1, factual_safety=1, is_factually_safe=False)),
    ("We have cancelled your order now", "Refund Request", None, dict(groundedness=3, factual_safety=1)),
    ("x" * 200, "Other", 0.46, dict(conciseness=5, groundedness=5)),
    ("x" * 201, "Other", 0.46, dict(conciseness=4)),
    ("x" * 281, "Other", 0.46, dict(conciseness=3)),
])
def test_rubric(spark, reply, intent, score, want):
    df = spark.createDataFrame([(reply, intent, score)], "suggested_reply string, intent string, top_score double")
    row = replies.score_reply(df).first()
    assert {k: row[k] for k in want} == want
    parts = ("relevance", "groundedness", "factual_safety", "actionability", "tone", "conciseness")
    assert row.total_score == sum(row[p] for p in parts)
    published = replies.score_reply(df, evidence_score=F.lit(0.0)).first()
    assert published.groundedness == (1 if row.factual_safety == 1 else 3)


# The published confusion counts and pairs of ratings.
CONFUSION = [
    [32, 0, 0, 0, 2, 1, 0, 0], [4, 11, 0, 0, 0, 0, 0, 0], [1, 0, 16, 0, 1, 1, 0, 0], [4, 0, 1, 16, 0, 0, 0, 0],
    [0, 0, 0, 0, 10, 0, 0, 11], [2, 1, 0, 0, 0, 12, 0, 0], [0, 0, 0, 0, 1, 0, 15, 0], [0, 0, 1, 0, 0, 0, 1, 13],
]
RATINGS = (
    "28,25 28,25 29,25 27,25 29,27 25,24 25,24 29,24 28,26 29,27 24,24 28,27 29,27 25,24 27,25 29,25 29,24 28,28 27,24 "
    "29,25 29,25 28,27 26,25 29,28 28,26 29,25 29,26 28,25 28,26 29,24 29,25 26,24 28,25 28,24 24,25 25,24 25,24 28,25 "
    "26,25 26,27"
)


def test_published_classification(spark):
    names = packs.TAXONOMY.labels
    rows = [(names[i], names[j]) for i, line in enumerate(CONFUSION) for j, n in enumerate(line) for _ in range(n)]
    df = spark.createDataFrame(rows, "y string, p string")
    row = metrics.classification(df, "y", "p").first()
    assert tuple(row) == (157, 0.7962, 0.7960, 0.7959, 0.8250, 0.7915)
    matrix = metrics.confusion_matrix(df, "y", "p", list(names)).collect()
    assert [list(r)[1:] for r in matrix] == CONFUSION


def test_published_agreement(spark):
    rows = [tuple(map(int, p.split(","))) for p in RATINGS.split()]
    df = spark.createDataFrame(rows, "a int, b int")
    assert tuple(metrics.agreement(df, "a", "b").first()) == (40, 5.0, 35.0, 57.5, 2.35, 0.4027, 0.3811)


def test_constant_scores_and_missing_labels(spark):
    same = spark.createDataFrame([(3, 1), (3, 2)], "a int, b int")
    row = metrics.agreement(same, "a", "b").first()
    assert (row.pearson, row.spearman) == (1.0, 1.0)
    df = spark.createDataFrame([("a", "b"), ("a", "a")], "y string, p string")
    report = {r.label: tuple(r)[1:] for r in metrics.per_class_report(df, "y", "p", ["a", "b", "c"]).collect()}
    assert report == {"a": (1.0, 0.5, 0.6667, 2), "b": (0.0, 0.0, 0.0, 0), "c": (0.0, 0.0, 0.0, 0)}


def test_two_decimals_follow_the_binary_value(spark):
    row = spark.range(1).select(*[F.format_number(F.lit(x), 2).alias(f"c{n}") for n, x in enumerate((0.285, 0.125, 0.515))]).first()
    assert list(row) == ["%.2f" % x for x in (0.285, 0.125, 0.515)]


def test_ranks_and_percentiles_of_fractions_and_outliers(spark):
    import numpy as np
    import pandas as pd

    from caseflow.operators import features

    draw = np.random.default_rng(0)
    x, y = draw.random(300).round(3), draw.random(300).round(2)
    x[0] = 1e12
    df = spark.createDataFrame(pd.DataFrame({"a": x, "b": y}))
    assert metrics.agreement(df, "a", "b").first()["spearman"] == pytest.approx(pd.Series(x).rank().corr(pd.Series(y).rank()), abs=1e-4)
    row = features.describe(df, "a").first()
    assert [row[f"p{int(100 * p)}"] for p in features.POINTS] == pytest.approx(list(np.quantile(x, features.POINTS)))
