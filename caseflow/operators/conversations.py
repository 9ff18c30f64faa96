"""From raw messages to clean conversations, first messages and resolution pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from caseflow.functions import text as t
from caseflow.functions.packs import TAXONOMY
from caseflow.functions.rules import Taxonomy
from caseflow.operators.joins import skewed_join
from caseflow.operators.ranks import ordered_position
from caseflow.session import materialize

TRAIN_SPLIT = "train_retrieval"


def parse_created_at(col: Column) -> Column:
    """``Tue Oct 31 22:10:47 +0000 2017``; anything else gives null."""
    return F.try_to_timestamp(F.substring(col, 5, 100), F.lit("MMM dd HH:mm:ss Z yyyy"))


def attach_components(messages: DataFrame, components: DataFrame) -> DataFrame:
    """Both sides have one row per message, so no key is hot."""
    return messages.join(components, "tweet_id")


def _bad_text() -> Column:
    return F.col("text").isNull() | t.is_blank(F.col("text"))


def _bad_time() -> Column:
    return ~_bad_text() & parse_created_at(F.col("created_at")).isNull()


def component_flags(messages: DataFrame, brand: Column) -> DataFrame:
    """What all rules ask of a component, in one aggregate: ``stage`` is the first of rules 1 to 3 that drops it, or 9.

    Authors beyond the first are told by min and max, so no set of authors is kept and
    the whole aggregate combines on the map side. ``bad_texts`` and ``bad_times`` are the rows for rules 4 and 5.
    """
    outbound = ~F.col("inbound")
    author = F.when(outbound, F.col("author_id"))
    found = messages.groupBy("component_id").agg(
        F.coalesce(F.bool_or(outbound & (F.col("author_id") == brand)), F.lit(False)).alias("has_brand"),
        F.coalesce(F.bool_or("inbound"), F.lit(False)).alias("has_customer"),
        (F.min(author) == F.max(author)).alias("one_brand"),
        F.count("*").alias("rows"),
        F.count_if(_bad_text()).alias("bad_texts"),
        F.count_if(_bad_time()).alias("bad_times"),
    )
    stage = (
        F.when(~F.col("has_brand"), 1).when(~F.col("has_customer"), 2)
        .when(~F.coalesce("one_brand", F.lit(False)), 3).otherwise(9)
    )
    return found.withColumn("stage", stage)


def build_conversations(messages: DataFrame, brand: Column) -> DataFrame:
    """Rules 1 to 5, then the 0-based turn within the component by time and id."""
    return build_with_accounting(messages, brand)[0]


def build_with_accounting(messages: DataFrame, brand: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations, and what each rule dropped on the way.

    Two passes of the messages: one aggregate a component, and one that writes the kept rows. Rows that rules 4 and 5
    drop are counted by an observation while they are written.
    """
    flags = materialize(component_flags(messages, brand), "components")
    keep = flags.where("stage = 9").select("component_id")
    sizes = flags.select("component_id", F.col("rows").alias("_n"))
    rows = skewed_join(messages, keep, "component_id", "left_semi", counts=sizes)
    seen = Observation()
    observed = rows.observe(
        seen, F.count_if(_bad_text()).alias("bad_texts"), F.count_if(_bad_time()).alias("bad_times"), F.count("*").alias("rows")
    )
    kept = observed.where(~_bad_text()).withColumn("created_at", parse_created_at(F.col("created_at"))).where("created_at IS NOT NULL")
    kept = materialize(kept.select("tweet_id", "component_id", "author_id", "inbound", "created_at", "text"), "conversations")
    found = seen.get
    texts, times, total = (found.get(c, 0) for c in ("bad_texts", "bad_times", "rows"))
    return turn_index(kept), _accounting(flags, F.lit(texts), F.lit(times), F.lit(total - texts - times))


def turn_index(rows: DataFrame) -> DataFrame:
    numbered = ordered_position(rows, "component_id", ["created_at", "tweet_id"], "turn_index")
    return numbered.withColumn("turn_index", F.col("turn_index").cast("long"))


def drop_accounting(messages: DataFrame, brand: Column) -> DataFrame:
    """``rule, dropped_components, dropped_rows, kept_components, kept_rows`` per rule, from one pass.

    The rules run in order: each counts only what the earlier ones left.
    """
    kept = F.col("stage") == 9
    texts, times = (F.coalesce(F.sum(F.when(kept, F.col(c))), F.lit(0)) for c in ("bad_texts", "bad_times"))
    rest = F.coalesce(F.sum(F.when(kept, F.col("rows") - F.col("bad_texts") - F.col("bad_times"))), F.lit(0))
    return _accounting(component_flags(messages, brand), texts, times, rest)


def _accounting(flags: DataFrame, bad_texts: Column, bad_times: Column, kept_rows: Column) -> DataFrame:
    stage, left = F.col("stage"), F.col("rows") - F.col("bad_texts")
    dropped = [F.coalesce(F.sum(F.when(stage == s, F.col("rows"))), F.lit(0)) for s in (1, 2, 3)] + [bad_texts, bad_times]
    alive = [F.count("*"), *[F.count_if(stage > s) for s in (1, 2, 3)]]
    alive += [F.count_if((stage == 9) & (left > 0)), F.count_if((stage == 9) & (left > F.col("bad_times")))]
    totals = flags.agg(
        *[c.alias(f"c{k}") for k, c in enumerate(alive)],
        *[c.cast("long").alias(f"d{k}") for k, c in enumerate(dropped, 1)], kept_rows.cast("long").alias("d9"),
    )
    names = ["R1 brand reply", "R2 customer message", "R3 single brand", "R4 text", "R5 time"]
    later = ["d2+d3+d4+d5+d9", "d3+d4+d5+d9", "d4+d5+d9", "d5+d9", "d9"]
    entries = ", ".join(f"'{names[i]}', c{i} - c{i + 1}, d{i + 1}, c{i + 1}, {later[i]}" for i in range(5))
    return totals.selectExpr(
        f"stack(5, {entries}) AS (rule, dropped_components, dropped_rows, kept_components, kept_rows)"
    )


def blank_and_null_texts(messages: DataFrame) -> DataFrame:
    return messages.agg(
        F.count_if(F.col("text").isNull()).alias("null_texts"),
        F.count_if(t.is_blank(F.col("text"))).alias("blank_texts"),
    )


def _first(messages: DataFrame) -> DataFrame:
    """Whole first row per component; min_by combines on the map side, so no sort."""
    others = [c for c in messages.columns if c != "component_id"]
    return (
        messages.groupBy("component_id")
        .agg(F.min_by(F.struct(*others), F.col("turn_index")).alias("row"))
        .select("component_id", "row.*")
    )


def first_inbound(messages: DataFrame) -> DataFrame:
    return _first(messages.where("inbound"))


def first_reply(messages: DataFrame, brand: Column | None = None) -> DataFrame:
    replies = messages.where("NOT inbound")
    return _first(replies if brand is None else replies.where(F.col("author_id") == brand))


def component_sizes(messages: DataFrame) -> DataFrame:
    return messages.groupBy("component_id").agg(F.count("*").alias("component_size"))


def resolution_pairs(
    messages: DataFrame,
    assignment: DataFrame,
    brand: Column | None = None,
    min_reply_len: int = 15,
    min_customer_len: int = 5,
    split: str = TRAIN_SPLIT,
    taxonomy: Taxonomy = TAXONOMY,
) -> DataFrame:
    """First customer message and first brand reply of each component of one split.

    Both firsts come from one pass over the messages: a component's rows are aggregated
    once, with each side's columns blanked out on the other side's rows.
    """
    train = assignment.where(F.col("split") == split).select("component_id", "heuristic_intent")
    is_reply = ~F.col("inbound")
    if brand is not None:
        is_reply = is_reply & (F.col("author_id") == brand)

    def first_of(side: Column) -> Column:
        turn = F.when(side, F.col("turn_index"))
        return F.min_by(F.struct(turn.alias("turn"), F.col("text")), turn)

    firsts = messages.groupBy("component_id").agg(
        first_of(F.col("inbound")).alias("customer"), first_of(is_reply).alias("agent")
    )
    return (
        firsts.where("agent.turn > customer.turn")
        .join(train, "component_id")
        .select(
            "component_id",
            t.strip(F.col("customer.text")).alias("customer_text"),
            t.strip(F.col("agent.text")).alias("agent_reply"),
            taxonomy.label_of(F.col("heuristic_intent")).alias("intent"),
        )
        .where(F.length("agent_reply") >= min_reply_len)
        .where(F.length("customer_text") >= min_customer_len)
        .select(
            t.case_id(F.col("component_id")).alias("case_id"),
            "component_id",
            "customer_text",
            t.clean(F.col("customer_text")).alias("cleaned_customer_text"),
            "agent_reply",
            "intent",
        )
    )


def labelled_first_messages(
    messages: DataFrame, assignment: DataFrame, split: str, taxonomy: Taxonomy = TAXONOMY
) -> DataFrame:
    """Training or validation rows: first messages of one split with an in-scope label."""
    chosen = assignment.where(F.col("split") == split).select("component_id", "heuristic_intent")
    return (
        first_inbound(messages)
        .join(chosen, "component_id")
        .withColumn("intent", taxonomy.label_of(F.col("heuristic_intent")))
        .where(taxonomy.in_scope(F.col("intent")))
        .withColumn("cleaned_text", t.clean(F.col("text")))
    )


def corpus_intents(corpus: DataFrame) -> DataFrame:
    return corpus.groupBy("intent").agg(F.count("*").alias("pairs"))
