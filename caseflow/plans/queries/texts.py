"""Text functions, rule tags and gates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions import text as t
from caseflow.functions.rules import RulePack
from caseflow.operators import conversations as conv
from caseflow.operators import tagging
from caseflow.plans.queries import base
from caseflow.sources import standin

PACK = base.PACK
GATE_TEXT = "documents"


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = standin.table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(t.clean(F.col("text"))).alias("cleaned_md5"))


def clean_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = standin.table(spark, sf_dir, "pages")
    return pages.select(
        "page_id", F.md5(t.clean(F.concat_ws(" ", F.lit("see"), "url", "html"))).alias("cleaned_md5"),
        F.md5(t.normalize_for_topics(F.concat_ws(" ", F.lit("@Agent"), "url", "html"))).alias("normal_md5"),
    )


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standin.messages_raw(spark, sf_dir).select(
        "tweet_id", F.md5(t.normalize_for_counts(F.col("text"))).alias("norm_md5"),
        F.md5(t.normalize_for_topics(F.col("text"))).alias("topic_md5"),
        t.word_count(F.col("text")).alias("words"),
    )


def scrub_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    replies = standin.messages_raw(spark, sf_dir).where("NOT inbound")
    signed = F.concat(F.lit("@cust "), F.col("text"), F.lit(" ^SJ "))
    return replies.select("tweet_id", F.md5(t.scrub_reply(signed)).alias("reply_md5"))


def text_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = standin.table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", t.case_id(F.col("o_orderkey")).alias("case_id"), t.golden_id(F.col("o_orderkey")).alias("golden_id"),
        t.merge_notes(F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).otherwise("")).alias("note"),
    )


def tag_first_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = standin.messages_raw(spark, sf_dir)
    tagged = tagging.tag(rows, PACK)
    return tagged.select(
        "tweet_id", "is_non_english", "heuristic_intent",
        packs.INTENT_PACK.first_match(F.col("text")).alias("default_tag"),
        PACK.hit_count(F.col("text")).cast("bigint").alias("hits"),
        F.array_join(PACK.hit_names(F.col("text")), ",").alias("hit_names"),
        packs.TAXONOMY.label_of(F.col("heuristic_intent")).alias("label"),
        packs.TAXONOMY.tag_of(packs.TAXONOMY.label_of(F.col("heuristic_intent"))).alias("tag_again"),
    )


def keyword_group_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = conv.first_inbound(base.messages(spark, sf_dir))
    return tagging.rule_shares(first, packs.KEYWORD_PACK).unionByName(tagging.rule_shares(first, PACK))


def rule_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.overlap(conv.first_inbound(base.messages(spark, sf_dir)), PACK)


def default_rule_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.overlap(standin.messages_raw(spark, sf_dir).where("inbound"))


def core_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = conv.first_inbound(base.messages(spark, sf_dir))
    return tagging.core_counts(first, PACK, r"\b(er|en|es)\b")


def review_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.condition_counts(standin.messages_raw(spark, sf_dir).where("inbound"), tagging.review_conditions())


def sample_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = base.stored_messages(spark, sf_dir)
    rules = {n: PACK.flag(F.col("text"), n) for n in PACK.names}
    return tagging.sample_matches(conv.first_inbound(stored), conv.first_reply(stored), rules, 6, 7)


def _gates(text: F.Column) -> dict[str, F.Column]:
    return tagging.gate_flags(text)


def language_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = standin.table(spark, sf_dir, GATE_TEXT)
    return docs.select("doc_id", *[c.alias(n) for n, c in _gates(F.col("text")).items()])


def language_gate_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = standin.table(spark, sf_dir, GATE_TEXT)
    gate = _gates(F.col("text"))["unsupported_language"]
    return docs.groupBy("lang", gate.alias("escalated")).agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    clean_text, clean_pages, normalize_text, scrub_reply, text_formats, tag_first_match, keyword_group_share,
    rule_overlap, default_rule_overlap, core_conditions, review_conditions, sample_matches, language_gate,
    language_gate_confusion,
)}


def _shares(source: str, pack: RulePack) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER ({base.sql_match('text', p)}) AS matched, "
        f"round(100.0 * count(*) FILTER ({base.sql_match('text', p)}) / count(*), 2) AS pct FROM {source}"
        for n, p in pack.rules
    )


def _overlaps(source: str, pack: RulePack) -> str:
    flags = ", ".join(f"{base.sql_match('text', p)} AS f_{n}" for n, p in pack.rules)
    pairs = [(a, b) for i, a in enumerate(pack.names) for b in pack.names[i + 1:]]
    rows = " UNION ALL ".join(
        f"""SELECT '{a}' AS rule_a, '{b}' AS rule_b, count(*) FILTER (f_{a}) AS a, count(*) FILTER (f_{b}) AS b,
        count(*) FILTER (f_{a} AND f_{b}) AS n_both FROM f""" for a, b in pairs
    )
    return f""", f AS (SELECT {flags} FROM {source}), p AS ({rows})
        SELECT *, a - n_both AS a_only, b - n_both AS b_only,
               coalesce(round(100.0 * n_both / nullif(a, 0), 1), 0) AS pct_of_a FROM p"""


def _conditions(source: str, conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS condition, count(*) FILTER ({c}) AS matched, "
        f"round(100.0 * count(*) FILTER ({c}) / count(*), 2) AS pct FROM {source}" for n, c in conditions.items()
    )


_review = {n: base.sql_match("text", p) for n, p in packs.REVIEW_PACK.rules}
_hits = base.sql_hit_count("text", PACK)
_complains = base.sql_match("text", r"\b(er|en|es)\b")
_foreign = (
    f"({base.sql_match('text', packs.GATE_LANGUAGE)} OR regexp_matches(text, "
    r"'[\x{3040}-\x{30ff}\x{3400}-\x{4dbf}\x{4e00}-\x{9fff}\x{0600}-\x{06ff}\x{0400}-\x{04ff}]'))"
)
_label = base.sql_label("heuristic_intent")
_tag_again = "CASE " + _label + " " + " ".join(
    f"WHEN '{b}' THEN '{a}'" for a, b in packs.TAXONOMY.tag_to_label
) + " END"

ORACLES = {
    "clean_text": f"SELECT doc_id, md5({base.sql_clean('text')}) AS cleaned_md5 FROM documents",
    "clean_pages": rf"""SELECT page_id, md5({base.sql_clean("concat_ws(' ', 'see', url, html)")}) AS cleaned_md5,
        md5({base.sql_normal("concat_ws(' ', '@Agent', url, html)", " ")}) AS normal_md5 FROM pages""",
    "normalize_text": rf"""WITH {base.MSG} SELECT tweet_id, md5({base.sql_normal("text")}) AS norm_md5,
        md5({base.sql_normal("text", " ")}) AS topic_md5,
        len(list_filter(string_split({base.sql_normal("text", " ")}, ' '), lambda w: w <> '')) AS words FROM raw""",
    "scrub_reply": rf"""WITH {base.MSG} SELECT tweet_id, md5(trim(regexp_replace(trim(regexp_replace(regexp_replace(
        '@cust ' || text || ' ^SJ ', '@[\p{{L}}\p{{N}}_]+', '', 'g'), '\s+', ' ', 'g')),
        '[\^–-][A-Z]{{1,3}}\s*$', ''))) AS reply_md5 FROM raw WHERE NOT inbound""",
    "text_formats": """SELECT o_orderkey, 'case_' || o_orderkey AS case_id,
        'g' || CASE WHEN o_orderkey > 9999 THEN CAST(o_orderkey AS VARCHAR) ELSE lpad(CAST(o_orderkey AS VARCHAR), 4, '0') END AS golden_id,
        CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority || ' | ' || o_orderstatus ELSE o_orderpriority END AS note
        FROM orders""",
    "tag_first_match": f"""WITH {base.MSG}, x AS (SELECT tweet_id, {base.sql_match("text", packs.SPLIT_LANGUAGE)} AS is_non_english,
        CASE WHEN {base.sql_match("text", packs.SPLIT_LANGUAGE)} THEN 'non_english_out_of_scope'
             ELSE {base.sql_first_match("text", PACK)} END AS heuristic_intent,
        {base.sql_first_match("text", packs.INTENT_PACK)} AS default_tag, {_hits} AS hits,
        array_to_string(list_filter([{", ".join(f"CASE WHEN {base.sql_match('text', p)} THEN '{n}' END" for n, p in PACK.rules)}],
          lambda x: x IS NOT NULL), ',') AS hit_names FROM raw)
        SELECT *, {_label} AS label, {_tag_again} AS tag_again FROM x""",
    "keyword_group_share": f"WITH {base.MSG} {_shares('first_in', packs.KEYWORD_PACK)} UNION ALL {_shares('first_in', PACK)}",
    "rule_overlap": f"WITH {base.MSG} {_overlaps('first_in', PACK)}",
    "default_rule_overlap": f"WITH {base.MSG} {_overlaps('raw WHERE inbound', packs.REVIEW_PACK)}",
    "core_conditions": f"WITH {base.MSG} " + _conditions("first_in", {
        "multi_core": f"{_hits} >= 2", "any_core": f"{_hits} > 0", "complaint": _complains,
        "complaint_and_core": f"{_complains} AND {_hits} > 0", "complaint_only": f"{_complains} AND {_hits} = 0",
    }),
    "review_conditions": f"WITH {base.MSG} " + _conditions("raw WHERE inbound", {
        "prime_residual": f"{_review['prime']} AND NOT {_review['prime_charge']} AND NOT {_review['prime_cancel']}",
        "order_cancel_without_prime": f"{_review['order_cancel']} AND NOT {_review['prime']}",
        "charge_without_prime": f"{_review['charge']} AND NOT {_review['prime']}",
        "charge_without_prime_and_refund": f"{_review['charge']} AND NOT {_review['prime']} AND {_review['refund']}",
        "charge_without_prime_and_account": f"{_review['charge']} AND NOT {_review['prime']} AND {_review['account']}",
    }),
    "sample_matches": f"""WITH {base.MSG}, h AS ({" UNION ALL ".join(
        f"SELECT component_id, text, '{n}' AS rule FROM first_in WHERE {base.sql_match('text', p)}" for n, p in PACK.rules)}),
        k AS (SELECT *, row_number() OVER (PARTITION BY rule ORDER BY md5('7:' || component_id), component_id) AS rank FROM h)
        SELECT rule, CAST(rank AS INT) AS rank, component_id, k.text, o.text AS reply
        FROM k LEFT JOIN first_out o USING (component_id) WHERE rank <= 6""",
    "language_gate": f"""SELECT doc_id, {_foreign} AS unsupported_language,
        {base.sql_match("text", packs.GATE_HUMAN)} AS human_request FROM documents""",
    "language_gate_confusion": f"SELECT lang, {_foreign} AS escalated, count(*) AS n FROM documents GROUP BY 1, 2",
}
