"""Rule tags, rule statistics and the language and human-request gates."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions import text as t
from caseflow.functions.rules import RulePack, Taxonomy, matches
from caseflow.operators.ranks import top_n


def tag(
    messages: DataFrame,
    pack: RulePack = packs.INTENT_PACK,
    language: str = packs.SPLIT_LANGUAGE,
    taxonomy: Taxonomy = packs.TAXONOMY,
) -> DataFrame:
    """Adds ``is_non_english`` and ``heuristic_intent``; the language marker wins."""
    marked = messages.withColumn("is_non_english", matches(F.col("text"), language))
    return marked.withColumn(
        "heuristic_intent",
        F.when(F.col("is_non_english"), F.lit(taxonomy.non_english_tag))
        .otherwise(pack.first_match(F.col("text"))),
    )


MASK_BITS = 63


def hit_masks(messages: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """``mask, n``: messages by the set of flags they hold, bit k for the k-th flag, each flag tested once a message.

    One row has no message and no flag, so that counts over an empty table are zeros. All shares, pairs and combinations
    are read from this table, which has as many rows as sets that occur.
    """
    if len(flags) > MASK_BITS:
        raise ValueError(f"at most {MASK_BITS} flags fit a mask")
    mask = F.lit(0).cast("long")
    for bit, flag in enumerate(flags.values()):
        mask = mask.bitwiseOR(F.when(flag, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
    counted = messages.select(mask.alias("mask")).groupBy("mask").agg(F.count("*").alias("n"))
    return counted.unionByName(messages.sparkSession.range(1).select(F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("n")))


def _holds(bit: Column) -> Column:
    return F.getbit("mask", bit) == 1


def _numbers(masks: DataFrame, names: list[str], keep: str) -> DataFrame:
    """``keep, matched, pct`` of every flag."""
    each = F.array(*[F.struct(F.lit(k).alias("bit"), F.lit(name).alias(keep)) for k, name in enumerate(names)])
    counted = masks.select("mask", "n", F.explode(each).alias("e")).groupBy(f"e.{keep}").agg(
        F.sum("n").alias("_total"), F.sum(F.when(_holds(F.col("e.bit")), F.col("n")).otherwise(0)).alias("matched"))
    return counted.select(
        keep, "matched", F.coalesce(F.round(F.try_divide(100 * F.col("matched"), F.col("_total")), 2), F.lit(0.0)).alias("pct"))


def _flags(pack: RulePack) -> dict[str, Column]:
    return {name: pack.flag(F.col("text"), name) for name in pack.names}


def rule_shares(messages: DataFrame, pack: RulePack = packs.KEYWORD_PACK) -> DataFrame:
    """``rule, matched, pct`` for every rule from one pass over the messages."""
    return _numbers(hit_masks(messages, _flags(pack)), pack.names, "rule")


def overlap(messages: DataFrame, pack: RulePack = packs.REVIEW_PACK) -> DataFrame:
    """Counts for every pair of rules, from the masks of one pass.

    ``rule_a, rule_b, a, b, n_both, a_only, b_only, pct_of_a``.
    """
    pairs = F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(a).alias("rule_a"), F.lit(b).alias("rule_b"))
        for (i, a), (j, b) in combinations(enumerate(pack.names), 2)
    ])
    held = hit_masks(messages, _flags(pack)).select("mask", "n", F.explode(pairs).alias("p"))
    a, b = _holds(F.col("p.i")), _holds(F.col("p.j"))
    number = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    counts = held.groupBy("p.rule_a", "p.rule_b").agg(number(a).alias("a"), number(b).alias("b"), number(a & b).alias("n_both"))
    return counts.select(
        "rule_a", "rule_b", "a", "b", "n_both",
        (F.col("a") - F.col("n_both")).alias("a_only"),
        (F.col("b") - F.col("n_both")).alias("b_only"),
        F.coalesce(F.round(F.try_divide(100 * F.col("n_both"), F.col("a")), 1), F.lit(0.0)).alias("pct_of_a"),
    )


def condition_counts(messages: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """``condition, matched, pct`` for named boolean columns, from one pass."""
    return _numbers(hit_masks(messages, conditions), list(conditions), "condition")


def review_conditions(pack: RulePack = packs.REVIEW_PACK) -> dict[str, Column]:
    """The masks of the intent reviews that are not plain pairs."""
    text = F.col("text")
    f = {name: pack.flag(text, name) for name in pack.names}
    return {
        "prime_residual": f["prime"] & ~f["prime_charge"] & ~f["prime_cancel"],
        "order_cancel_without_prime": f["order_cancel"] & ~f["prime"],
        "charge_without_prime": f["charge"] & ~f["prime"],
        "charge_without_prime_and_refund": f["charge"] & ~f["prime"] & f["refund"],
        "charge_without_prime_and_account": f["charge"] & ~f["prime"] & f["account"],
    }


def core_counts(
    messages: DataFrame, core: RulePack = packs.CORE_PACK, complaint: str = packs.COMPLAINT, multi: int = 2
) -> DataFrame:
    """``condition, matched, pct``: several core patterns at once, and complaints with and without one.

    Each pattern is tested once a message; the conditions are combinations of bits.
    """
    masks = hit_masks(messages, {**_flags(core), "complaint": matches(F.col("text"), complaint)})
    hits, complains = F.bit_count(F.col("mask").bitwiseAND(F.lit((1 << len(core.names)) - 1))), _holds(F.lit(len(core.names)))
    conditions = {
        "multi_core": hits >= multi,
        "any_core": hits > 0,
        "complaint": complains,
        "complaint_and_core": complains & (hits > 0),
        "complaint_only": complains & (hits == 0),
    }
    mask = F.lit(0).cast("long")
    for bit, condition in enumerate(conditions.values()):
        mask = mask.bitwiseOR(F.when(condition, F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
    return _numbers(masks.select(mask.alias("mask"), "n"), list(conditions), "condition")


def sample_matches(
    messages: DataFrame,
    replies: DataFrame,
    conditions: dict[str, Column],
    n: int,
    seed: int,
) -> DataFrame:
    """Up to ``n`` example rows per condition, with the component's first reply if any."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in conditions.items()]))
    hits = messages.select("component_id", "text", F.explode(names).alias("rule")).withColumn(
        "_h", t.seeded_hash(seed, F.col("component_id"))
    )
    chosen = top_n(hits, ["rule"], ["_h", "component_id"], n, "component_id").drop("_h")
    # at most n rows per rule are chosen: a bounded list, and it thins out the replies
    reply = replies.select("component_id", F.col("text").alias("reply")).join(
        F.broadcast(chosen.select("component_id").distinct()), "component_id", "left_semi"
    )
    return chosen.join(reply, "component_id", "left").select(
        "rule", "rank", "component_id", "text", "reply"
    )


def gate_flags(
    text: Column, flag: Column | None = None,
    language: str = packs.GATE_LANGUAGE, scripts: str = packs.GATE_SCRIPTS,
    human: str = packs.GATE_HUMAN,
) -> dict[str, Column]:
    """``unsupported_language`` and ``human_request`` for a message column."""
    foreign = matches(text, language) | F.coalesce(text.rlike(scripts), F.lit(False))
    if flag is not None:
        foreign = foreign | F.coalesce(flag, F.lit(False))
    return {"unsupported_language": foreign, "human_request": matches(text, human)}


def tag_label_disagreement(golden: DataFrame, taxonomy: Taxonomy = packs.TAXONOMY) -> DataFrame:
    """``rule_label, human_intent, n`` where a rule's label differs from the person's."""
    compared = golden.where(F.col("heuristic_intent") != taxonomy.fallback_tag).withColumn(
        "rule_label", taxonomy.label_of(F.col("heuristic_intent"))
    )
    return (
        compared.where(F.col("rule_label") != F.col("human_intent"))
        .groupBy("rule_label", "human_intent").agg(F.count("*").alias("n"))
    )
