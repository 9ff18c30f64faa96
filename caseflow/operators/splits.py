"""Leakage-safe splits, quota samples, labels and leakage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions import text as t
from caseflow.functions.rules import RulePack, Taxonomy
from caseflow.operators.conversations import TRAIN_SPLIT, component_sizes, first_inbound
from caseflow.operators.ranks import hashed_position, top_n
from caseflow.operators.tagging import tag
from caseflow.session import materialize

SEED = 42
OUT_SPLIT = "out_of_scope_non_english"


def _whole(col: str) -> Column:
    """Counts as decimals: the product of two counts may pass 64 bits."""
    return F.col(col).cast("decimal(18,0)")


def largest_remainder(strata: DataFrame, count: str, draws: Column, output: str) -> DataFrame:
    """Shares ``draws`` among strata in proportion to ``count``.

    Whole parts first, then one more for the largest remainders; equal remainders go by
    stratum name. ``strata`` has one row per stratum, so the windows are tiny.
    """
    everything = W.partitionBy(F.lit(1))
    base = (
        strata.withColumn("_all", F.sum(count).over(everything))
        .withColumn("_draws", draws.cast("bigint"))
        .withColumn("_exact", _whole("_draws") * _whole(count))
        .withColumn("_floor", F.expr(
            "CASE WHEN _all = 0 THEN 0L ELSE _exact div CAST(_all AS DECIMAL(18,0)) END"))
        .withColumn("_rest", F.col("_exact") - _whole("_floor") * _whole("_all"))
        .withColumn("_open", F.col("_draws") - F.sum("_floor").over(everything))
    )
    by_rest = everything.orderBy(F.desc("_rest"), "stratum")
    return base.withColumn(
        output,
        F.col("_floor") + (F.row_number().over(by_rest) <= F.col("_open")).cast("bigint"),
    ).drop("_all", "_draws", "_exact", "_floor", "_rest", "_open")


def split_quotas(strata: DataFrame, held_out: float = 0.2, test_share: float = 0.5) -> DataFrame:
    """``stratum, n, train, validation, test`` from ``stratum, n``.

    The held-out part is rounded up, and so is the test half of it.
    """
    everything = W.partitionBy(F.lit(1))
    total = F.sum("n").over(everything)
    train = largest_remainder(
        strata.withColumn("_t", total - F.ceil(total * held_out)), "n", F.col("_t"), "train"
    ).drop("_t")
    held = train.withColumn("_held", F.col("n") - F.col("train"))
    held_total = F.sum("_held").over(everything)
    valid = largest_remainder(
        held.withColumn("_t", held_total - F.ceil(held_total * test_share)),
        "_held", F.col("_t"), "validation",
    )
    return valid.select(
        "stratum", "n", "train", "validation",
        (F.col("_held") - F.col("validation")).alias("test"),
    )


def stratified_split(
    df: DataFrame,
    row_id: str,
    stratum: str,
    seed: int = SEED,
    held_out: float = 0.2,
    test_share: float = 0.5,
    names: tuple[str, str, str] = (TRAIN_SPLIT, "validation", "test"),
) -> DataFrame:
    """Adds ``split``. Ranks come from hash slices, so a stratum of any size stays even.

    A null stratum is a stratum of its own. The quota table has one row per stratum; it is written, so
    that Spark knows its size and broadcasts it only if that is small.
    """
    strata = df.groupBy(F.col(stratum).alias("stratum")).agg(F.count("*").alias("n"))
    quotas = materialize(split_quotas(strata, held_out, test_share).select("stratum", "train", "validation"), "quotas")
    quotas = quotas.withColumnRenamed("stratum", "_stratum")
    ranked = hashed_position(df, [stratum], row_id, seed, "_rank")
    train, validation, test = names
    return (
        ranked.join(quotas, F.col(stratum).eqNullSafe(F.col("_stratum")))
        .withColumn(
            "split",
            F.when(F.col("_rank") <= F.col("train"), train)
            .when(F.col("_rank") <= F.col("train") + F.col("validation"), validation)
            .otherwise(test),
        )
        .drop("_rank", "train", "validation", "_stratum")
    )


def assign_splits(
    messages: DataFrame,
    pack: RulePack = packs.INTENT_PACK,
    language: str = packs.SPLIT_LANGUAGE,
    seed: int = SEED,
    taxonomy: Taxonomy = packs.TAXONOMY,
) -> DataFrame:
    """``component_id, heuristic_intent, is_non_english, split`` for every conversation."""
    tagged = tag(first_inbound(messages), pack, language, taxonomy).select(
        "component_id", "heuristic_intent", "is_non_english"
    )
    inside = stratified_split(tagged.where("NOT is_non_english"), "component_id", "heuristic_intent", seed)
    outside = tagged.where("is_non_english").withColumn("split", F.lit(OUT_SPLIT))
    return inside.unionByName(outside).select(
        "component_id", "heuristic_intent", "is_non_english", "split"
    )


def split_stats(assignment: DataFrame, tags: list[str]) -> DataFrame:
    """Split by tag counts, zero where a pair does not occur."""
    return (
        assignment.groupBy("split").pivot("heuristic_intent", tags).agg(F.count(F.lit(1)))
        .na.fill(0, tags)
    )


def messages_per_split(messages: DataFrame, assignment: DataFrame) -> DataFrame:
    """``split, components, customer_messages`` (all customer turns)."""
    turns = messages.where("inbound").groupBy("component_id").agg(F.count("*").alias("m"))
    return (
        assignment.join(turns, "component_id", "left").groupBy("split")
        .agg(F.count("*").alias("components"), F.coalesce(F.sum("m"), F.lit(0)).alias("customer_messages"))
    )


def split_violations(assignment: DataFrame) -> DataFrame:
    """Components with more than one row or split; must be empty."""
    return (
        assignment.groupBy("component_id")
        .agg(F.count("*").alias("rows"), F.count_distinct("split").alias("splits"))
        .where("rows > 1 OR splits > 1")
    )


def rare_tags(assignment: DataFrame, tags: list[str]) -> DataFrame:
    kept = assignment.where(F.col("heuristic_intent").isin(*tags))
    return kept.groupBy("heuristic_intent", "split").agg(F.count("*").alias("n"))


def quota_table(df: DataFrame, quotas: dict[str, int], key: str) -> DataFrame:
    rows = [(k, int(v)) for k, v in quotas.items()]
    return df.sparkSession.createDataFrame(rows, f"{key} string, quota int")


def quota_sample(
    pool: DataFrame, key: str, row_id: str, quotas: dict[str, int], seed: int = SEED
) -> DataFrame:
    """Up to a quota of rows per key, chosen by seeded hash."""
    table = quota_table(pool, quotas, key)
    hashed = pool.join(F.broadcast(table), key).withColumn("_h", t.seeded_hash(seed, F.col(row_id)))
    ranked = top_n(hashed, [key], ["_h", row_id], max(quotas.values()), row_id)
    return ranked.where(F.col("rank") <= F.col("quota")).drop("_h", "quota")


def mixed_quota_sample(
    pool: DataFrame,
    quotas: dict[str, int],
    key: str = "heuristic_intent",
    row_id: str = "component_id",
    hits: str = "n_pattern_hits",
    multi_share: float = packs.MULTI_HIT_FRACTION,
    plain: str = "unmatched_other",
    seed: int = SEED,
) -> DataFrame:
    """Quota sample that prefers a share of rows which several rules hit.

    Per key: ``multi_share`` of the quota (half-even) from rows with two hits or more,
    the rest from the others, and further multi-hit rows when those run short. The
    ``plain`` key is sampled without the mix. Adds ``is_multi``.
    """
    table = quota_table(pool, quotas, key)
    flagged = pool.join(F.broadcast(table), key).withColumn(
        "is_multi", (F.col(hits) >= 2) & (F.col(key) != plain)
    ).withColumn("_h", t.seeded_hash(seed, F.col(row_id)))
    ranked = top_n(flagged, [key, "is_multi"], ["_h", row_id], max(quotas.values()), row_id, "_rank")
    # ranked holds at most two quotas of rows per key; so do the windows over it
    per_key = W.partitionBy(key)
    n_multi_pool = F.count_if("is_multi").over(per_key)
    n_single_pool = F.count_if(~F.col("is_multi")).over(per_key)
    quota = F.least(F.col("quota").cast("bigint"), n_multi_pool + n_single_pool)
    return (
        ranked.withColumn("_quota", quota)
        .withColumn("_multi", F.when(F.col(key) == plain, 0).otherwise(
            F.least(F.bround(F.col("_quota") * multi_share).cast("bigint"), n_multi_pool)))
        .withColumn("_single", F.least(F.col("_quota") - F.col("_multi"), n_single_pool))
        .withColumn("_extra", F.col("_quota") - F.col("_multi") - F.col("_single"))
        .where(
            (F.col("is_multi") & (F.col("_rank") <= F.col("_multi") + F.col("_extra")))
            | (~F.col("is_multi") & (F.col("_rank") <= F.col("_single")))
        )
        .drop("_h", "_rank", "_quota", "_multi", "_single", "_extra", "quota")
    )


def build_golden_set(
    messages: DataFrame,
    assignment: DataFrame,
    pack: RulePack = packs.INTENT_PACK,
    quotas: dict[str, int] = packs.GOLDEN_QUOTAS,
    non_english_quota: int = packs.NON_ENGLISH_QUOTA,
    seed: int = SEED,
) -> DataFrame:
    """Benchmark rows from the test split, plus some non-English ones, with notes."""
    pool = (
        first_inbound(messages)
        .select("component_id", "tweet_id", "text")
        .join(assignment, "component_id")
        .withColumn("n_pattern_hits", pack.hit_count(F.col("text")))
    )
    tested = mixed_quota_sample(pool.where("split = 'test'"), quotas, seed=seed).withColumn(
        "note",
        F.when(F.col("heuristic_intent") == pack.default, packs.NOTE_UNMATCHED)
        .when(F.col("is_multi"), t.fill(packs.NOTE_MULTI, F.col("n_pattern_hits").cast("string")))
        .otherwise(packs.NOTE_SINGLE),
    )
    outside = quota_sample(
        pool.where(F.col("split") == OUT_SPLIT), "split", "component_id",
        {OUT_SPLIT: non_english_quota}, seed,
    ).drop("rank").withColumn("is_multi", F.lit(False)).withColumn(
        "note", F.lit(packs.NOTE_NON_ENGLISH)
    )
    order = F.coalesce(*[
        F.when(F.col("heuristic_intent") == name, F.lit(i)) for i, name in enumerate(quotas)
    ], F.lit(len(quotas)))
    sizes = component_sizes(messages)
    sampled = tested.unionByName(outside).withColumn("_order", order)
    # the sampled set is bounded by the quotas, so one ordered window over it is small
    numbered = sampled.withColumn(
        "_n",
        F.row_number().over(W.partitionBy(F.lit(1)).orderBy(
            "_order", F.desc("is_multi"), t.seeded_hash(seed, F.col("component_id")), "component_id")),
    )
    wanted = sizes.join(F.broadcast(numbered.select("component_id")), "component_id", "left_semi")
    return numbered.join(wanted, "component_id").select(
        t.golden_id(F.col("_n")).alias("golden_id"),
        F.col("tweet_id").alias("source_tweet_id"),
        "component_id",
        "text",
        "heuristic_intent",
        F.lit("").alias("human_intent"),
        F.lit("").alias("difficulty"),
        F.when(F.col("split") == OUT_SPLIT, "out_of_scope_non_english_heuristic")
        .otherwise("in_scope_english_heuristic").alias("language_scope"),
        F.col("note").alias("annotator_notes"),
        "n_pattern_hits",
        "component_size",
    )


def apply_labels(golden: DataFrame, labels: DataFrame) -> DataFrame:
    """Attach a person's labels by golden id; keep the sampling note in front."""
    given = labels.select(
        "golden_id", F.col("human_intent").alias("_i"), F.col("difficulty").alias("_d"), F.col("note").alias("_n")
    )
    return (
        golden.join(given, "golden_id", "left")
        .withColumn("human_intent", F.col("_i"))
        .withColumn("difficulty", F.col("_d"))
        .withColumn("annotator_notes", t.merge_notes(
            F.coalesce("annotator_notes", F.lit("")), F.coalesce("_n", F.lit(""))))
        .drop("_i", "_d", "_n")
    )


def validate_labels(
    golden: DataFrame, labels: DataFrame, taxonomy: Taxonomy = packs.TAXONOMY,
    difficulties: tuple[str, ...] = packs.DIFFICULTIES,
) -> DataFrame:
    """``check, violations``; a usable label table has zeros only."""
    missing = golden.join(labels, "golden_id", "left_anti").agg(F.count("*").alias("violations"))
    unknown = labels.join(golden, "golden_id", "left_anti").agg(F.count("*").alias("violations"))
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    rest = labels.agg(
        F.count_if(~empty("human_intent") & ~F.col("human_intent").isin(*taxonomy.all_labels)).alias("bad_intent"),
        F.count_if(~empty("difficulty") & ~F.col("difficulty").isin(*difficulties)).alias("bad_difficulty"),
        F.count_if(empty("human_intent")).alias("empty_intent"),
        F.count_if(empty("difficulty")).alias("empty_difficulty"),
    ).selectExpr(
        "stack(4, 'intent not allowed', bad_intent, 'difficulty not allowed', bad_difficulty, "
        "'intent empty', empty_intent, 'difficulty empty', empty_difficulty) AS (check, violations)"
    )
    named = lambda df, name: df.select(F.lit(name).alias("check"), "violations")
    sizes = golden.agg(F.count("*").alias("n")).unionByName(labels.agg((-F.count("*")).alias("n")))
    size = sizes.agg(F.abs(F.sum("n")).alias("violations")).select(F.lit("size difference").alias("check"), "violations")
    return (
        named(missing, "golden id without label")
        .unionByName(named(unknown, "label without golden id"))
        .unionByName(size).unionByName(rest)
    )


def label_distribution(golden: DataFrame, columns: list[str]) -> DataFrame:
    """``dimension, value, n`` for several columns from one pass."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return (
        golden.selectExpr(f"stack({len(columns)}, {pairs}) AS (dimension, value)")
        .groupBy("dimension", "value").agg(F.count("*").alias("n"))
    )


def leakage_check(checks: dict[str, tuple[DataFrame, DataFrame]], key: str = "component_id") -> DataFrame:
    """``check, overlap``: distinct keys that both sides hold; must be zero."""
    result = None
    for name, (left, right) in checks.items():
        shared = left.select(key).join(right.select(key), key, "left_semi")
        row = shared.agg(F.count_distinct(key).alias("overlap")).select(F.lit(name).alias("check"), "overlap")
        result = row if result is None else result.unionByName(row)
    return result


def split_leakage(assignment: DataFrame, golden: DataFrame, corpus: DataFrame) -> DataFrame:
    part = lambda name: assignment.where(F.col("split") == name)
    return leakage_check({
        "golden vs train": (golden, part(TRAIN_SPLIT)),
        "golden vs validation": (golden, part("validation")),
        "corpus vs validation": (corpus, part("validation")),
        "corpus vs test": (corpus, part("test")),
        "corpus vs golden": (corpus, golden),
    })


def text_leakage(first_messages: DataFrame, assignment: DataFrame) -> DataFrame:
    """Normalised texts that occur in more than one split (ids alone cannot tell)."""
    split_texts = (
        first_messages.select("component_id", t.normalize_for_counts(F.col("text")).alias("norm"))
        .join(assignment.select("component_id", "split"), "component_id")
        .groupBy("norm").agg(F.count_distinct("split").alias("splits"), F.count("*").alias("rows"))
    )
    return split_texts.agg(
        F.count_if(F.expr("splits > 1")).alias("shared_texts"),
        F.coalesce(F.sum(F.when(F.col("splits") > 1, F.col("rows"))), F.lit(0)).alias("rows_with_shared_text"),
    )
