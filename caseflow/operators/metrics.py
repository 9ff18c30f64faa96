"""Classification, decision, reply-quality and agreement measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions.rules import Taxonomy
from caseflow.operators.ranks import quantile_bins


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def per_label(df: DataFrame, truth: str, pred: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., label, tp, fp, fn, support, precision, recall, f1`` for every label seen.

    Rows are counted per (truth, prediction) pair first; all else works on those counts,
    whose number depends on the label set alone.
    """
    pairs = df.groupBy(*by, F.col(truth).alias("y"), F.col(pred).alias("p")).agg(F.count("*").alias("n"))
    hit = F.col("y") == F.col("p")
    sides = pairs.select(*by, "n", F.explode(F.when(hit, F.array(
        F.struct(F.col("y").alias("label"), F.lit("tp").alias("kind")),
    )).otherwise(F.array(
        F.struct(F.col("y").alias("label"), F.lit("fn").alias("kind")),
        F.struct(F.col("p").alias("label"), F.lit("fp").alias("kind")),
    ))).alias("s"))
    add = lambda kind: F.coalesce(F.sum(F.when(F.col("s.kind") == kind, F.col("n"))), F.lit(0))
    counts = sides.groupBy(*by, F.col("s.label").alias("label")).agg(
        add("tp").alias("tp"), add("fp").alias("fp"), add("fn").alias("fn")
    )
    return (
        counts.withColumn("support", F.col("tp") + F.col("fn"))
        .withColumn("precision", _ratio(F.col("tp"), F.col("tp") + F.col("fp")))
        .withColumn("recall", _ratio(F.col("tp"), F.col("support")))
        .withColumn("f1", _ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")))
    )


def classification(df: DataFrame, truth: str, pred: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Accuracy, macro and weighted scores over labels in truth or prediction."""
    total = F.sum("support")
    return per_label(df, truth, pred, by).groupBy(*by).agg(
        total.alias("n"),
        F.round(_ratio(F.sum("tp"), total), 4).alias("accuracy"),
        F.round(F.avg("f1"), 4).alias("macro_f1"),
        F.round(_ratio(F.sum(F.col("f1") * F.col("support")), total), 4).alias("weighted_f1"),
        F.round(F.avg("precision"), 4).alias("macro_precision"),
        F.round(F.avg("recall"), 4).alias("macro_recall"),
    )


def _label_rows(df: DataFrame, labels: list[str]) -> DataFrame:
    rows = [(i, x) for i, x in enumerate(labels)]
    return df.sparkSession.createDataFrame(rows, "position int, label string")


def per_class_report(df: DataFrame, truth: str, pred: str, labels: list[str]) -> DataFrame:
    """One row per requested label, zero where it was not seen."""
    seen = per_label(df, truth, pred).select("label", "precision", "recall", "f1", "support")
    return (
        _label_rows(df, labels).join(seen, "label", "left")
        .select("label", *[F.round(F.coalesce(c, F.lit(0.0)), 4).alias(c) for c in ("precision", "recall", "f1")],
                F.coalesce("support", F.lit(0)).alias("support"))
    )


def confusion_matrix(df: DataFrame, truth: str, pred: str, labels: list[str]) -> DataFrame:
    """Fixed rows and columns in label order, zero-filled."""
    counts = (
        df.where(F.col(truth).isin(*labels)).groupBy(F.col(truth).alias("label"))
        .pivot(pred, labels).agg(F.count(F.lit(1)))
    )
    return (
        _label_rows(df, labels).join(counts, "label", "left").na.fill(0, labels)
        .orderBy("position").select("label", *[f"`{x}`" for x in labels])
    )


def in_scope_report(df: DataFrame, truth: str, pred: str, taxonomy: Taxonomy = packs.TAXONOMY) -> DataFrame:
    """Scores for in-scope rows, overall and per difficulty, from one grouped job."""
    inside = df.where(taxonomy.in_scope(F.col(truth)))
    tiers = inside.withColumn("tier", F.explode(F.array(F.lit("All"), F.col("difficulty"))))
    return classification(tiers, truth, pred, ("tier",))


def scope_totals(df: DataFrame, truth: str, taxonomy: Taxonomy = packs.TAXONOMY) -> DataFrame:
    inside = taxonomy.in_scope(F.col(truth))
    return df.agg(
        F.count("*").alias("total"), F.count_if(inside).alias("in_scope"), F.count_if(~inside).alias("out_of_scope")
    )


def compare_models(predictions: dict[str, DataFrame], truth: str, pred: str = "intent") -> DataFrame:
    """One row of scores per model; the models' predictions are scored together."""
    stacked = None
    for name, df in predictions.items():
        part = df.select(F.lit(name).alias("model"), truth, pred)
        stacked = part if stacked is None else stacked.unionByName(part)
    return classification(stacked, truth, pred, ("model",))


def decision_rates(df: DataFrame, decision: str = "decision") -> DataFrame:
    share = lambda v: F.round(_ratio(100.0 * F.count_if(F.col(decision) == v), F.count("*")), 2)
    return df.agg(
        F.count("*").alias("total"), share("ESCALATE").alias("escalation_rate_pct"),
        share("AUTO_HANDLE").alias("auto_handle_rate_pct"),
    )


def requires_escalation(truth: Column, difficulty: Column, taxonomy: Taxonomy = packs.TAXONOMY) -> Column:
    return ~taxonomy.in_scope(truth) | taxonomy.risky(truth) | F.coalesce(difficulty == "Hard", F.lit(False))


def binary_scores(df: DataFrame, truth: Column, pred: Column) -> DataFrame:
    """Precision, recall and F1 of one boolean against another."""
    tp, fp, fn = F.count_if(truth & pred), F.count_if(~truth & pred), F.count_if(truth & ~pred)
    return df.agg(
        F.round(_ratio(tp, tp + fp), 4).alias("precision"),
        F.round(_ratio(tp, tp + fn), 4).alias("recall"),
        F.round(_ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1"),
    )


RUBRIC = ("total_score", "relevance", "groundedness", "factual_safety", "actionability", "tone", "conciseness")


def reply_quality(df: DataFrame) -> DataFrame:
    """Mean of each rubric score and the safe share over replies that would be sent."""
    sent = df.where(F.col("decision") == "AUTO_HANDLE")
    return sent.agg(
        F.count("*").alias("replies"),
        *[F.round(F.avg(c), 4).alias(f"mean_{c}") for c in RUBRIC],
        F.round(_ratio(100.0 * F.count_if("is_factually_safe"), F.count("*")), 2).alias("safe_pct"),
    )


def _average_ranks(pairs: DataFrame, side: str, by: list[str]) -> DataFrame:
    """``by..., side, rank_side``: mean rank of each distinct value.

    Values are cut into bins of about equally many; ranks within a bin are shifted by the rows in
    lower bins. A window thus sees the distinct values of one bin, or the bins of a group.
    """
    values = pairs.groupBy(*by, side).agg(F.sum("n").alias("ties")).withColumn("bin", quantile_bins(pairs, side, 64))
    before = W.partitionBy(*by).orderBy("bin").rowsBetween(W.unboundedPreceding, -1)
    bins = values.groupBy(*by, "bin").agg(F.sum("ties").alias("n")).select(
        *by, "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )
    within = W.partitionBy(*by, "bin").orderBy(side).rowsBetween(W.unboundedPreceding, -1)
    below = F.coalesce(F.sum("ties").over(within), F.lit(0))
    return values.withColumn("below", below).join(bins, [*by, "bin"]).select(
        *by, side, (F.col("shift") + F.col("below") + (F.col("ties") + 1) / 2).alias(f"rank_{side}")
    )


def _pearson(x: str, y: str) -> Column:
    """Weighted by ``n``; 1.0 where a side does not vary (built-in ``corr`` would raise)."""
    n = F.col("n")
    moment = lambda u, v: F.sum(n * F.col(u) * F.col(v)) - F.sum(n * F.col(u)) * F.sum(n * F.col(v)) / F.sum(n)
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varies, F.try_divide(moment(x, y), F.sqrt(moment(x, x)) * F.sqrt(moment(y, y)))).otherwise(F.lit(1.0))


def agreement(df: DataFrame, a: str, b: str, by: tuple[str, ...] = ()) -> DataFrame:
    """How far two ratings agree: exact, within 1 and 2, error, Pearson and Spearman.

    Rows are reduced to counts per pair of scores at once, so a score that most rows share
    is no hot key later. ``by`` names report dimensions, of which there are few.
    """
    group = [*by, "_all"]
    pairs = (
        df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
        .groupBy(*by, F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
        .agg(F.count("*").alias("n")).withColumn("_all", F.lit(0))
    )
    ranked = pairs
    for side in ("a", "b"):
        ranked = ranked.join(_average_ranks(pairs, side, group), [*group, side])
    n = F.col("n")
    gap = F.abs(F.col("a") - F.col("b"))
    share = lambda c: F.round(100 * F.sum(F.when(c, n).otherwise(0)) / F.sum(n), 2)
    return ranked.groupBy(*group).agg(
        F.sum(n).alias("sample_size"),
        share(gap == 0).alias("exact_agreement_pct"),
        share(gap <= 1).alias("within_1_pct"),
        share(gap <= 2).alias("within_2_pct"),
        F.round(F.sum(n * gap) / F.sum(n), 4).alias("mean_absolute_error"),
        F.round(_pearson("a", "b"), 4).alias("pearson"),
        F.round(_pearson("rank_a", "rank_b"), 4).alias("spearman"),
    ).drop("_all")
