"""Topic clusters over messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions import text as t
from caseflow.operators import features as fx
from caseflow.operators.ranks import top_n
from caseflow.session import materialize

# Clusters, terms and examples of the topic study.
CLUSTERS = 14
TOP_TERMS = 12
EXAMPLES = 5


@dataclass
class TopicClusters:
    """Messages with their cluster, and what is needed to describe the clusters."""

    members: DataFrame
    vocab: DataFrame
    vectors: DataFrame
    model: KMeansModel
    row_id: str

    def summary(self) -> DataFrame:
        """``cluster, size, pct_of_total, top_terms, examples``, largest first.

        Centroids (clusters x vocabulary numbers, both capped) come from the driver, where
        the model lives. Members are scored where they lie and five per cluster remain.
        """
        spark = self.members.sparkSession
        centers = [
            (c, i, float(w)) for c, center in enumerate(self.model.clusterCenters())
            for i, w in enumerate(center) if w > 0
        ]
        weights = spark.createDataFrame(centers, "cluster int, idx int, weight double")
        terms = (
            top_n(weights.join(F.broadcast(self.vocab.select("idx", "term")), "idx"), ["cluster"],
                  [F.desc("weight"), F.col("term")], TOP_TERMS, "term")
            .groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("t"))
            .select("cluster", F.array_join("t.term", ", ").alias("top_terms"))
        )
        scored = (
            self.vectors.join(self.members.select(self.row_id, "cluster"), self.row_id)
            .select(self.row_id, "cluster", F.explode(F.arrays_zip("idx", "val")).alias("e"))
            .select(self.row_id, "cluster", F.col("e.idx").alias("idx"), F.col("e.val").alias("val"))
            .join(F.broadcast(weights), ["cluster", "idx"])
            .groupBy(self.row_id, "cluster").agg(F.sum(F.col("val") * F.col("weight")).alias("dot"))
        )
        nearest = top_n(scored, ["cluster"], [F.desc(F.round("dot", 9)), F.col(self.row_id)], EXAMPLES, self.row_id)
        examples = (
            self.members.select(self.row_id, "text").join(F.broadcast(nearest), self.row_id)
            .groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("x"))
            .select("cluster", F.col("x.text").alias("examples"))
        )
        sizes = self.members.groupBy("cluster").agg(F.count("*").alias("size"))
        total = self.members.count()
        return (
            sizes.join(terms, "cluster", "left").join(examples, "cluster", "left")
            .select("cluster", "size", F.round(100 * F.col("size") / total, 2).alias("pct_of_total"), "top_terms", "examples")
            .orderBy(F.desc("size"), "cluster")
        )


def fit_topics(
    messages: DataFrame, row_id: str, text: str, k: int = CLUSTERS, seed: int = 42,
    stop_words: tuple[str, ...] | None = None, spec: fx.TermSpec | None = None,
) -> TopicClusters:
    stop = stop_words if stop_words is not None else fx.english_stop_words()
    spec = spec or fx.topic_words(stop)
    docs = messages.select(row_id, F.col(text).alias("text"), t.normalize_for_topics(F.col(text)).alias("norm"))
    counts = materialize(fx.term_counts(docs, row_id, "norm", spec), "topic-counts")
    vocab = materialize(fx.vocabulary(counts, fx.count_docs(docs), spec), "topic-vocabulary")
    vectors = materialize(fx.weights(counts, vocab, row_id, spec), "topic-vectors")
    rows = materialize(fx.union_vectors(docs, row_id, [(vectors, vocab.count())], "features"), "topic-features")
    # read once per step, so held on the executors, without the texts
    held = rows.select("features").persist()
    try:
        model = KMeans(k=k, seed=seed, predictionCol="cluster").fit(held)
    finally:
        held.unpersist()
    members = materialize(model.transform(rows).select(row_id, "text", "cluster"), "topic-members")
    return TopicClusters(members, vocab, vectors, model, row_id)
