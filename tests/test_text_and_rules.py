import pytest
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions import text as t
from caseflow.functions.rules import RulePack
from caseflow.operators import tagging


def texts(spark, rows):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id long, text string")


def column(df, name="out"):
    return [r[name] for r in df.orderBy("id").collect()]


def test_clean(spark):
    rows = ["@bob hi https://t.co/x there", "go www.site.com now", "café “ok” \U0001f600!", "$12.99 a_b", "a\t b", "", None]
    got = column(texts(spark, rows).withColumn("out", t.clean(F.col("text"))))
    assert got == ["hi there", "go now", "caf ok !", "$12.99 a b", "a b", "", ""]


def test_normal_forms_and_word_count(spark):
    df = texts(spark, ["Hi @Bob,THERE https://x.y Z", "@a", None])
    assert column(df.withColumn("out", t.normalize_for_counts(F.col("text")))) == ["hi z", "", ""]
    assert column(df.withColumn("out", t.word_count(F.col("text")))) == [2, 0, 0]


def test_scrub_and_blank(spark):
    df = texts(spark, ["@c Thanks for asking ^SJ", "Ref no-ID", "See https://x.y ^abc", " \t"])
    assert column(df.withColumn("out", t.scrub_reply(F.col("text")))) == [
        "Thanks for asking", "Ref no", "See https://x.y ^abc", ""]
    assert column(df.withColumn("out", t.is_blank(F.col("text")))) == [False, False, False, True]


def test_formats_and_notes(spark):
    df = texts(spark, ["a", "", None]).withColumn("out", t.merge_notes(F.coalesce("text", F.lit("")), F.lit("new")))
    assert column(df) == ["a | new", "new", "new"]
    ids = spark.range(1).select(t.golden_id(F.lit(7)), t.golden_id(F.lit(12345)), t.case_id(F.lit(3))).first()
    assert list(ids) == ["g0007", "g12345", "case_3"]


TAGGED = [
    ("I am LOCKED OUT of my account", "account_access_security"),
    ("You charged me twice!", "unauthorized_nonprime_charge"),
    ("cancel my prime now", "prime_billing_cancellation"),
    ("please cancel the order", "order_cancellation"),
    ("it came damaged", "return_wrong_damaged"),
    ("I want a refund", "refund_request"),
    ("address is wrong", "address_redirect"),
    ("when will it arrive", "delivery_issue"),
    ("refund for the damaged one", "return_wrong_damaged"),
    ("hello there", "unmatched_other"),
    (None, "unmatched_other"),
    ("¿Dónde está mi ENVÍO? refund", "non_english_out_of_scope"),
    ("nao e nÃO", "non_english_out_of_scope"),
    ("obrigado", "unmatched_other"),
    ("cléque", "unmatched_other"),
]


def test_tags(spark):
    df = tagging.tag(texts(spark, [m for m, _ in TAGGED]))
    assert column(df, "heuristic_intent") == [tag for _, tag in TAGGED]


def test_hits_shares_and_overlap(spark):
    pack = RulePack((("a", r"\ba\b"), ("b", r"\bb\b"), ("c", r"\bc\b")))
    df = texts(spark, ["a b", "a", "b", "x", None])
    assert column(df.withColumn("out", pack.hit_count(F.col("text")))) == [2, 1, 1, 0, 0]
    shares = {r["rule"]: (r["matched"], r["pct"]) for r in tagging.rule_shares(df, pack).collect()}
    assert shares == {"a": (2, 40.0), "b": (2, 40.0), "c": (0, 0.0)}
    row = tagging.overlap(df, pack).where("rule_a = 'a' AND rule_b = 'b'").first()
    assert (row.n_both, row.a_only, row.b_only, row.pct_of_a) == (1, 1, 1, 50.0)
    none = tagging.overlap(df, pack).where("rule_a = 'b' AND rule_b = 'c'").first()
    assert none.pct_of_a == 0.0


@pytest.mark.parametrize("message, foreign, human", [
    ("Hola, necesito ayuda con mi pedido por favor.", True, False),
    ("こんにちは", True, False),
    ("Привет", True, False),
    ("let me talk to a human", False, True),
    ("both operators are busy", False, True),
    ("where is it", False, False),
    (None, False, False),
])
def test_gates(spark, message, foreign, human):
    flags = tagging.gate_flags(F.col("text"))
    row = texts(spark, [message]).select(*[c.alias(n) for n, c in flags.items()]).first()
    assert (row.unsupported_language, row.human_request) == (foreign, human)


def test_labels_both_ways(spark):
    df = texts(spark, ["refund_request", "no such tag", None])
    assert column(df.withColumn("out", packs.TAXONOMY.label_of(F.col("text")))) == [
        "Refund Request", "Other / Out of Scope", "Other / Out of Scope"]
    assert column(df.withColumn("out", packs.TAXONOMY.tag_of(F.lit("Refund Request"))))[0] == "refund_request"


def test_sample_matches_keeps_rows_without_reply(spark):
    first = spark.createDataFrame([(i, f"a {i}") for i in range(20)], "component_id long, text string")
    replies = spark.createDataFrame([(i, f"r {i}") for i in range(0, 20, 2)], "component_id long, text string")
    rows = tagging.sample_matches(first, replies, {"all": F.lit(True), "none": F.lit(False)}, 20, 7).collect()
    assert len(rows) == 20
    assert {r.component_id: r.reply for r in rows} == {i: (f"r {i}" if i % 2 == 0 else None) for i in range(20)}
