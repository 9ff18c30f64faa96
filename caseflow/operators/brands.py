"""One profile row per brand account."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions import text as t
from caseflow.operators import features as fx
from caseflow.operators.joins import skewed_join
from caseflow.operators.ranks import top_n
from caseflow.session import materialize

# Clusters of the diversity check, and the size of its published sample.
CLUSTERS = 8
SAMPLE_MAX = 3_000


def brand_components(messages: DataFrame) -> DataFrame:
    """``brand, component_id, replies``: components a brand replied in.

    A component that two brands share counts for both.
    """
    return (
        messages.where("NOT inbound").groupBy(F.col("author_id").alias("brand"), "component_id")
        .agg(F.count("*").alias("replies"))
    )


def brand_metrics(messages: DataFrame) -> DataFrame:
    """Counts, rates and lengths per brand, without the text measures.

    Messages are first reduced to one row per component; only that small table meets the
    brand links, so no message is copied for a component with several brands.
    """
    sizes = messages.groupBy("component_id").agg(
        F.count("*").alias("size"), F.count_if("inbound").alias("customers")
    )
    joined = brand_components(messages).join(sizes, "component_id")
    percent = lambda a, b, d=2: F.coalesce(F.round(F.try_divide(100 * a, b), d), F.lit(0.0))
    return joined.groupBy("brand").agg(
        F.count("*").alias("n_conversation_components"),
        F.sum("customers").alias("n_customer_messages"),
        F.sum("replies").alias("n_brand_replies"),
        percent(F.count_if(F.expr("customers > 0")), F.count("*")).alias("pct_with_brand_response"),
        F.percentile("size", 0.5).alias("median_length"),
        F.round(F.avg("size"), 3).alias("mean_length"),
        percent(F.count_if(F.expr("size > 2")), F.count("*")).alias("pct_multi_turn"),
        F.count_if(F.expr("customers > 0")).alias("n_usable_cases"),
    )


def brand_texts(messages: DataFrame) -> DataFrame:
    """``brand, norm, n``: customer texts of a brand's components after normalising.

    Copies are merged per component before the brands are attached, and again after.
    """
    texts = (
        messages.where("inbound")
        .groupBy("component_id", t.normalize_for_counts(F.col("text")).alias("norm"))
        .agg(F.count("*").alias("n"))
    )
    return (
        skewed_join(texts, brand_components(messages).select("brand", "component_id"), "component_id")
        .groupBy("brand", "norm").agg(F.sum("n").alias("n"))
    )


def duplicate_rates(texts: DataFrame) -> DataFrame:
    distinct, total = F.count("*"), F.sum("n")
    return texts.groupBy("brand").agg(
        distinct.alias("n_distinct_messages"),
        F.round(100 * (1 - distinct / total), 2).alias("duplicate_pct"),
    )


def _numbered_texts(texts: DataFrame) -> DataFrame:
    return texts.where("norm <> ''").select("brand", F.concat_ws(":", "brand", F.md5("norm")).alias("text_id"), "norm")


def diversity_sample(texts: DataFrame, n: int = SAMPLE_MAX, seed: int = 42) -> DataFrame:
    """Up to ``n`` distinct texts per brand, by a seeded hash: the sample of the published measure."""
    hashed = _numbered_texts(texts).withColumn("_h", t.seeded_hash(seed, F.col("norm")))
    return top_n(hashed, ["brand"], ["_h", "norm"], n, "norm").drop("_h", "rank")


def _measure(rows: DataFrame, brand: str, k: int, seed: int) -> tuple[float | None, float]:
    """Silhouette (squared Euclidean) and balance of one brand's k-means clusters."""
    own = rows.where(F.col("brand") == brand).select("features").persist()
    try:
        model = KMeans(k=k, seed=seed, predictionCol="cluster").fit(own)
        sizes = model.summary.clusterSizes
        several = sum(n > 0 for n in sizes) > 1
        score = ClusteringEvaluator(predictionCol="cluster").evaluate(model.transform(own)) if several else None
        return score, 1 - max(sizes) / sum(sizes)
    finally:
        own.unpersist()


def brand_diversity(
    texts: DataFrame, k: int = CLUSTERS, sample: int | None = None, seed: int = 42,
    stop_words: tuple[str, ...] | None = None, at_once: int = 4,
) -> DataFrame:
    """TF-IDF clusters of each brand's distinct texts: ``sample_size, k, silhouette, cluster_balance``, or a ``note`` why there are none.

    All texts of a brand are clustered, unless ``sample`` asks for the published sample of so many. A brand is clustered and evaluated by
    Spark ML over its own folder of vectors, ``at_once`` brands side by side; one number of rows and of terms a brand reaches the driver.
    """
    spec = fx.brand_words(stop_words if stop_words is not None else fx.english_stop_words())
    picked = materialize(_numbered_texts(texts) if sample is None else diversity_sample(texts, sample, seed), "brand-texts")
    by = ("brand",)
    counts = fx.term_counts(picked, "text_id", "norm", spec, by)
    vocab = materialize(fx.vocabulary(counts, fx.count_docs(picked, by), spec, by), "brand-vocabulary")
    vectors = fx.weights(counts, vocab, "text_id", spec, by)
    empty = F.array()
    rows = picked.select("brand", "text_id").join(vectors, ["brand", "text_id"], "left").select("brand", fx.to_sparse(
        F.coalesce("idx", empty.cast("array<int>")), F.coalesce("val", empty.cast("array<double>")), spec.max_features).alias("features"))
    rows = materialize(rows, "brand-vectors", by)
    widths = vocab.groupBy("brand").agg(F.count("*").alias("width"))
    sizes = picked.groupBy("brand").agg(F.count("*").alias("n")).join(widths, "brand", "left").na.fill(0, ["width"]).collect()
    few = {r["brand"]: packs.NOTE_FEW_TEXTS for r in sizes if r["n"] < k * 5}
    few |= {r["brand"]: packs.NOTE_FEW_TERMS for r in sizes if r["brand"] not in few and r["width"] < k}
    with ThreadPoolExecutor(at_once) as pool:
        found = dict(pool.map(lambda b: (b, _measure(rows, b, k, seed)), [r["brand"] for r in sizes if r["brand"] not in few]))
    table = [(r["brand"], r["n"], None if r["brand"] in few else k, *found.get(r["brand"], (None, None)), few.get(r["brand"], "")) for r in sizes]
    measured = texts.sparkSession.createDataFrame(
        table, "brand string, sample_size long, k int, silhouette double, cluster_balance double, note string")
    return measured.withColumn("silhouette", F.round("silhouette", 4)).withColumn("cluster_balance", F.round("cluster_balance", 4))


def brand_profile(messages: DataFrame, with_diversity: bool = True) -> DataFrame:
    """The whole profile, brands with most components first."""
    texts = brand_texts(messages)
    profile = brand_metrics(messages).join(duplicate_rates(texts), "brand", "left")
    if with_diversity:
        profile = profile.join(brand_diversity(texts), "brand", "left")
    return profile.orderBy(F.desc("n_conversation_components"), "brand")
