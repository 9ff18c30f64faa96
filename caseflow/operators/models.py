"""Intent classifiers on Spark ML."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions import packs
from caseflow.functions import text as t
from caseflow.functions.rules import RulePack, Taxonomy
from caseflow.operators import features as fx
from caseflow.operators import grams, solver
from caseflow.operators.ranks import hashed_position
from caseflow.session import materialize

# Stop when the loss changes by less than this share; tighter values changed no label.
TOLERANCE = 1e-6
# Newton steps with halving end long before this; beyond it something is wrong.
NEWTON_ERROR = 1_000
# Training rows a task: at least so many if cores are to spare, and never more than so many.
ROWS_PER_TASK = 1_000
MOST_ROWS_PER_TASK = 50_000
MAX_LABELS = 1_000
# A fit that begins at its optimum (``solver``) ends there, if its gradient in scaled terms is at most this share of the loss.
START_TOLERANCE = 0.1
# Each fit holds its rows a second time while it runs.
FITS_AT_A_TIME = 2
# Rows that the solver takes at a time: for each such block it fills a whole matrix of classes and terms, so small blocks cost more than their rows.
BLOCK_MB = 16.0

# Thresholds of the classifier's own confidence flag.
MIN_CONFIDENCE = 0.55
MIN_MARGIN = 0.10


def label_table(train: DataFrame, label: str) -> list[str]:
    """The label names in order: the one thing about the rows that reaches the driver. More than ``MAX_LABELS`` are an error."""
    names = [r[0] for r in train.select(label).distinct().orderBy(label).limit(MAX_LABELS + 1).collect()]
    if len(names) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels in {label}")
    return names


def _label_index(col: Column, labels: list[str]) -> Column:
    return F.array_position(F.array(*[F.lit(x) for x in labels]), col).cast("double") - 1


def _label_name(index: Column, labels: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in labels]), (index + 1).cast("int"))


def _tasks(rows: DataFrame, n: int, fits: int = 1) -> int:
    cores = -(-rows.sparkSession.sparkContext.defaultParallelism // fits)
    return max(1, min(cores, -(-n // ROWS_PER_TASK)), -(-n // MOST_ROWS_PER_TASK))


def _spread(rows: DataFrame, n: int, fits: int = 1) -> DataFrame:
    """Training rows over as many tasks as they keep busy in a solver step: one a core, or more where a task would hold too many.

    ``fits`` that run side by side share the cores: each task of a step shuffles a whole gradient, so fewer tasks shuffle less.
    """
    return rows.repartition(_tasks(rows, n, fits))


def _java_model(spark: SparkSession, point: np.ndarray):
    """Coefficients and intercepts (the last column) of each class as a model of Spark's."""
    classes, context = len(point), spark.sparkContext
    matrix = DenseMatrix(classes, point.shape[1] - 1, point[:, :-1].ravel(order="F"))
    kind = context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel
    return kind("start", _py2java(context, matrix), _py2java(context, DenseVector(point[:, -1])), classes, True)


def _linear(fitted: list[LogisticRegressionModel]) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients of the fits side by side, one column for each fit and class, and their intercepts."""
    return np.concatenate([m.coefficientMatrix.toArray().T for m in fitted], axis=1), np.concatenate([m.interceptVector.toArray() for m in fitted])


def _converged(model: LogisticRegressionModel, max_iter: int) -> LogisticRegressionModel:
    """The model; an error if the solver ran out of iterations."""
    if model.summary.totalIterations >= max_iter:
        raise RuntimeError(f"no convergence in {max_iter} iterations; raise max_iter")
    return model


def _shares(values: Column, total: Column, even: Column) -> Column:
    return F.transform(values, lambda x: F.coalesce(F.try_divide(x, total), even))


@dataclass
class MajorityBaseline:
    """Always the most frequent training label; equal counts go by name."""

    label: str | None = None
    labels: list[str] | None = None

    def fit(self, train: DataFrame, label: str) -> "MajorityBaseline":
        counts = train.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)
        self.labels = label_table(train, label)
        self.label = counts.first()[0]
        return self

    def transform(self, rows: DataFrame) -> DataFrame:
        chances = F.map_from_arrays(
            F.array(*[F.lit(x) for x in self.labels]),
            F.array(*[F.lit(1.0 if x == self.label else 0.0) for x in self.labels]),
        )
        return rows.withColumn("intent", F.lit(self.label)).withColumn("probabilities", chances)


@dataclass(frozen=True)
class RuleClassifier:
    """Intents by the first rule that matches; sure where one rule matches, unsure where several or none do."""

    pack: RulePack
    taxonomy: Taxonomy = packs.TAXONOMY

    def transform(self, rows: DataFrame, row_id: str, text: str) -> DataFrame:
        hits = self.pack.hit_count(F.col(text))
        return (
            rows.withColumn("intent", self.taxonomy.label_of(self.pack.first_match(F.col(text))))
            .withColumn("confidence", F.when(hits > 0, F.round(1.0 / hits, 4)).otherwise(0.0))
            .withColumn("margin", F.when(hits == 1, 1.0).otherwise(0.0))
        )


@dataclass
class TfidfLogisticBaseline:
    """Single words, plain multinomial logistic regression, raw text."""

    stop_words: tuple[str, ...] | None = None
    c: float = 1.0
    max_iter: int = 2000

    def fit(self, train: DataFrame, row_id: str, text: str, label: str) -> "TfidfLogisticBaseline":
        stop = self.stop_words if self.stop_words is not None else fx.english_stop_words()
        self.spec = fx.baseline_words(stop)
        docs = train.select(row_id, F.coalesce(text, F.lit("")).alias("text"), label)
        counts, vocab = fx.fit_terms(docs, row_id, "text", self.spec)
        self.vocab = materialize(vocab, "baseline-vocabulary")
        self.size = self.vocab.count()
        self.labels = label_table(docs, label)
        block = fx.weights(counts, self.vocab, row_id, self.spec)
        rows = fx.union_vectors(docs, row_id, [(block, self.size)], "features").withColumn(
            "label", _label_index(F.col(label), self.labels)
        )
        rows = materialize(rows.select("label", "features"), "baseline-features")
        n = rows.count()
        self.model = _converged(LogisticRegression(
            family="multinomial", regParam=1.0 / (self.c * n), elasticNetParam=0.0,
            standardization=False, maxIter=self.max_iter, tol=TOLERANCE, maxBlockSizeInMB=BLOCK_MB,
        ).fit(_spread(rows, n)), self.max_iter)
        return self

    def transform(self, rows: DataFrame, row_id: str, text: str) -> DataFrame:
        docs = rows.select(row_id, F.coalesce(text, F.lit("")).alias("text"))
        block = fx.weights(fx.term_counts(docs, row_id, "text", self.spec), self.vocab, row_id, self.spec)
        vectors = fx.union_vectors(rows, row_id, [(block, self.size)], "features")
        scored = self.model.transform(vectors)
        return scored.withColumn("intent", _label_name(F.col("prediction"), self.labels)).withColumn(
            "probabilities",
            F.map_from_arrays(F.array(*[F.lit(x) for x in self.labels]), vector_to_array("probability")),
        ).drop("features", "rawPrediction", "probability", "prediction")


@dataclass
class IntentClassifier:
    """Word and character TF-IDF, class-balanced logistic regression, calibrated over folds.

    Each fold trains on the other folds and its margins on the held-out rows fit one
    sigmoid per class; probabilities are normalised over classes and averaged over folds.
    """

    c: float = 2.5
    folds: int = 5
    max_iter: int = 5000
    seed: int = 42
    word_spec: fx.TermSpec = fx.CLASSIFIER_WORDS
    char_spec: fx.TermSpec = fx.CLASSIFIER_CHARS

    def fit(self, train: DataFrame, row_id: str, text: str, label: str) -> "IntentModel":
        docs = train.select(row_id, t.clean(F.col(text)).alias("text"), F.col(label).alias("label"), F.monotonically_increasing_id().alias("_row"))
        docs = materialize(docs, "training", codec="zstd")
        labels = label_table(docs, "label")
        specs = [self.word_spec, self.char_spec]
        numbered = docs.select("_row", row_id, _label_index(F.col("label"), labels).cast("int").alias("y"))
        folds = materialize(self._with_fold(numbered, row_id).select("_row", "y", "fold"), "folds")
        counts = {(r["y"], r["fold"]): r["n"] for r in folds.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()}
        n, sublinear = sum(counts.values()), [spec.sublinear for spec in specs]
        placed = grams.placed(docs.join(folds, "_row"), row_id, "text", specs, ("y", "fold")).persist()
        try:
            vocabs = grams.vocabularies(placed, fx.count_docs(docs), specs)
            terms = fx.places(vocabs)
            packed = materialize(grams.packed(placed, vocabs, specs, "y", "fold"), "packed", codec="zstd")
        finally:
            placed.unpersist()
        # the packed rows are read once per solver step, so they are held on the executors; a task of a step sends a gradient
        held = packed.coalesce(_tasks(packed, n)).persist()
        try:
            starts = solver.fold_optima(held, counts, self.folds, len(labels), self.c, terms["idf"], sublinear)
            # the label's metadata names all classes, so a fold that lacks one keeps its place
            classes = {"ml_attr": {"type": "nominal", "name": "y", "vals": labels}}
            rows = grams.unpacked(_spread(packed, n, self.folds), terms["idf"], sublinear)
            rows = rows.select(F.col("y").alias("y", metadata=classes), "fold", "features").persist()
            try:
                with ThreadPoolExecutor(FITS_AT_A_TIME) as pool:
                    fitted = list(pool.map(lambda f: self._fit_fold(rows, f, counts, starts[f]), range(self.folds)))
            finally:
                rows.unpersist()
            sigmoids = self._fit_sigmoids(held, fitted, terms["idf"], sublinear)
        finally:
            held.unpersist()
        return IntentModel(labels, vocabs, specs, terms["sizes"], fitted, sigmoids)

    def _with_fold(self, numbered: DataFrame, row_id: str) -> DataFrame:
        return hashed_position(numbered, ["y"], row_id, self.seed, "_pos").withColumn(
            "fold", F.pmod(F.col("_pos") - 1, F.lit(self.folds)).cast("int")
        )

    def certificate(self, model: "IntentModel", train: DataFrame, row_id: str, text: str, label: str) -> DataFrame:
        """``fold, rows, largest_gradient``: how far each fold's coefficients are from the optimum.

        The gradient of the regularised objective at the fitted coefficients, over all training rows of a fold, is one grouped
        sum over the entries of their vectors; at the optimum every entry is 0. Coefficients are as many as classes times terms.
        """
        k, folds = len(model.labels), range(self.folds)
        docs = train.select(row_id, F.col(text).alias("text"), _label_index(F.col(label), model.labels).alias("y"))
        rows, size = model.entries(docs, row_id, "text", "idx", "val")
        rows = self._with_fold(rows.drop("text"), row_id).withColumn("features", fx.to_sparse(F.col("idx"), F.col("val"), size))
        sizes = materialize(rows.select("y", "fold", "idx", "val", "features"), "certificate")
        counts = {(r["y"], r["fold"]): r["n"] for r in sizes.groupBy("y", "fold").agg(F.count("*").alias("n")).collect()}
        scored, totals = sizes, []
        for f, fitted in zip(folds, model.fitted):
            own = {y: sum(n for (z, g), n in counts.items() if z == y and g != f) for y, _ in counts}
            own = {y: n for y, n in own.items() if n}
            totals.append(sum(own.values()))
            table = F.create_map(*[F.lit(x) for y, n in own.items() for x in (y, totals[f] / (len(own) * n))])
            weight = F.when(F.col("fold") != f, F.element_at(table, F.col("y")) / totals[f]).otherwise(0.0)
            scored = fitted.copy().setRawPredictionCol("").setPredictionCol("").setProbabilityCol(f"_q{f}").transform(scored)
            chances, hit = vector_to_array(f"_q{f}"), F.col("y")
            scored = scored.withColumn("_w", weight).withColumn(
                f"_r{f}", F.transform(chances, lambda p, c: (p - F.when(hit == c, 1.0).otherwise(0.0)) * F.col("_w"))).drop(f"_q{f}", "_w")
        each = F.explode(F.concat(F.arrays_zip("idx", "val"), F.array(F.struct(F.lit(-1).alias("idx"), F.lit(1.0).alias("val")))))
        long = scored.select(each.alias("e"), *[f"_r{f}" for f in folds])
        sums = [F.sum(F.col("e.val") * F.col(f"_r{f}")[c]).alias(f"g{f}_{c}") for f in folds for c in range(k)]
        slopes = long.groupBy("e.idx").agg(*sums)  # idx -1 is the intercept, which is not regularised
        parts = []
        for f, fitted in zip(folds, model.fitted):
            pull = (fitted.coefficientMatrix.toArray().T * (1.0 / (self.c * totals[f]))).tolist()  # plain floats: without Arrow, rows take no others
            known = train.sparkSession.createDataFrame(pd.DataFrame({"idx": range(size), "pull": pull}), "idx int, pull array<double>")
            met = slopes.select("idx", F.array(*[f"g{f}_{c}" for c in range(k)]).alias("g")).join(known, "idx", "full")
            zero = F.array(*[F.lit(0.0)] * k)
            off = F.zip_with(F.coalesce("g", zero), F.coalesce("pull", zero), lambda a, b: F.abs(a + b))
            parts.append(met.agg(F.max(F.array_max(off)).alias("largest_gradient")).select(
                F.lit(f).alias("fold"), F.lit(totals[f]).cast("long").alias("rows"), "largest_gradient"))
        return reduce(DataFrame.unionByName, parts)

    def _fit_fold(self, rows: DataFrame, fold: int, counts: dict[tuple[int, int], int], start: np.ndarray | None) -> LogisticRegressionModel:
        """The fit without a fold's rows. Spark's solver begins at ``start``, and goes on if that is not the optimum."""
        part = rows.where(F.col("fold") != fold)
        sizes = {y: sum(m for (z, f), m in counts.items() if z == y and f != fold) for y, _ in counts}
        sizes = {y: m for y, m in sizes.items() if m}
        n = sum(sizes.values())
        table = F.create_map(*[F.lit(x) for y, m in sizes.items() for x in (float(y), n / (len(sizes) * m))])
        weighted = part.withColumn("weight", F.element_at(table, F.col("y")))
        solved = LogisticRegression(
            labelCol="y", weightCol="weight", family="multinomial", regParam=1.0 / (self.c * n), elasticNetParam=0.0, standardization=False,
            maxIter=self.max_iter, tol=TOLERANCE if start is None else START_TOLERANCE, maxBlockSizeInMB=BLOCK_MB,
        )
        if start is not None:
            solved._java_obj.setInitialModel(_java_model(rows.sparkSession, start))
        return _converged(solved.fit(weighted), self.max_iter)

    def _fit_sigmoids(
        self, packed: DataFrame, fitted: list[LogisticRegressionModel], idf: np.ndarray, sublinear: list[bool]
    ) -> list[list[tuple[float, float]]]:
        """Slope and intercept per fold and class, fitted to smoothed 0/1 targets.

        All sigmoids take their Newton steps together: a step is one grouped sum over the
        held-out margins, and 20 to 40 rows of sums reach the driver.
        """
        k = fitted[0].numClasses
        held = grams.held_out(packed, *_linear(fitted), k, idf, sublinear)
        long = held.select("y", "fold", F.posexplode("m").alias("cls", "margin"))
        slot = F.col("fold") * k + F.col("cls")
        points = materialize(
            long.select(slot.alias("slot"), "margin", (F.col("y") == F.col("cls")).alias("hit")), "margins"
        )
        seen = points.groupBy("slot").agg(F.count_if("hit").alias("p"), F.count("*").alias("n")).collect()
        size = k * len(fitted)
        high, low, at = [1.0] * size, [0.0] * size, [(0.0, 0.0)] * size
        for r in seen:
            high[r["slot"]] = (r["p"] + 1.0) / (r["p"] + 2.0)
            low[r["slot"]] = 1.0 / (r["n"] - r["p"] + 2.0)
            at[r["slot"]] = (0.0, math.log((r["p"] + 1.0) / (r["n"] - r["p"] + 1.0)))
        pick = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), F.col("slot") + 1)
        points = points.withColumn("goal", F.when(F.col("hit"), pick(high)).otherwise(pick(low))).persist()
        try:
            return self._newton(points, pick, at, k)
        finally:
            points.unpersist()

    def _newton(self, points: DataFrame, pick, at: list[tuple[float, float]], k: int) -> list[list[tuple[float, float]]]:
        kept, loss = list(at), [math.inf] * len(at)
        moved, steps = math.inf, 0
        while moved >= 1e-5:
            if steps == NEWTON_ERROR:
                raise RuntimeError("the calibration does not converge")
            steps += 1
            z = pick([a for a, _ in at]) * F.col("margin") + pick([b for _, b in at])
            p, m = 1.0 / (1.0 + F.exp(-z)), F.col("margin")
            bend = p * (1 - p)
            sums = points.groupBy("slot").agg(
                F.sum(F.log1p(F.exp(-F.abs(z))) + F.greatest(z, F.lit(0.0)) - F.col("goal") * z).alias("loss"),
                F.sum((p - F.col("goal")) * m).alias("ga"), F.sum(p - F.col("goal")).alias("gb"),
                F.sum(bend * m * m).alias("haa"), F.sum(bend * m).alias("hab"), F.sum(bend).alias("hbb"),
            ).collect()
            moved = 0.0
            for r in sums:
                s = r["slot"]
                if r["loss"] > loss[s] + 1e-9:  # too far: go back half the way
                    at[s] = tuple((x + y) / 2 for x, y in zip(kept[s], at[s]))
                    moved = max(moved, *(abs(x - y) for x, y in zip(kept[s], at[s])))
                    continue
                kept[s], loss[s] = at[s], r["loss"]
                haa, hbb = r["haa"] + 1e-9, r["hbb"] + 1e-9
                det = haa * hbb - r["hab"] ** 2
                da, db = (hbb * r["ga"] - r["hab"] * r["gb"]) / det, (haa * r["gb"] - r["hab"] * r["ga"]) / det
                at[s] = (kept[s][0] - da, kept[s][1] - db)
                moved = max(moved, abs(da), abs(db))
        return [kept[f:f + k] for f in range(0, len(kept), k)]


@dataclass
class IntentModel:
    """A fitted classifier; scoring joins the vocabularies and applies the fold models."""

    labels: list[str]
    vocabs: list[DataFrame]
    specs: list[fx.TermSpec]
    sizes: list[int]
    fitted: list[LogisticRegressionModel]
    sigmoids: list[list[tuple[float, float]]]

    def entries(self, rows: DataFrame, row_id: str, text: str, idx: str, val: str) -> tuple[DataFrame, int]:
        """Rows with the places and weights of their vector as arrays, and its size."""
        names = [(f"_i{n}", f"_v{n}") for n in range(len(self.specs))]
        docs = rows.withColumn("_clean", t.clean(F.col(text)))
        found = grams.vectors(docs, row_id, "_clean", self.vocabs, self.specs, names)
        return fx.joined_entries(found, names, self.sizes, idx, val)

    def features(self, rows: DataFrame, row_id: str, text: str) -> DataFrame:
        found, size = self.entries(rows, row_id, text, "_idx", "_val")
        return found.withColumn("features", fx.to_sparse(F.col("_idx"), F.col("_val"), size)).drop("_idx", "_val")

    def predict_proba(self, rows: DataFrame, row_id: str, text: str) -> DataFrame:
        """Adds ``chances``, one probability per label in label order."""
        docs = rows.withColumn("_clean", t.clean(F.col(text)))
        scored = grams.margins(docs, row_id, "_clean", self.vocabs, self.specs, *_linear(self.fitted), "_margins")
        averaged = None
        for n, sigmoids in enumerate(self.sigmoids):
            scored = scored.withColumn(f"_m{n}", F.slice("_margins", n * len(sigmoids) + 1, len(sigmoids)))
            each = F.array(*[
                1.0 / (1.0 + F.exp(-(F.lit(a) * F.element_at(f"_m{n}", c + 1) + F.lit(b))))
                for c, (a, b) in enumerate(sigmoids)
            ])
            scored = scored.withColumn(f"_p{n}", each)
            total = F.aggregate(f"_p{n}", F.lit(0.0), lambda s, x: s + x)
            even = F.lit(1.0 / len(self.labels))
            share = _shares(F.col(f"_p{n}"), total, even)
            averaged = share if averaged is None else F.zip_with(averaged, share, lambda x, y: x + y)
        mean = F.transform(averaged, lambda x: x / F.lit(float(len(self.fitted))))
        own = [f"_{c}{n}" for n in range(len(self.fitted)) for c in ("m", "p")]
        return scored.withColumn("chances", mean).drop("_margins", *own)

    def transform(
        self, rows: DataFrame, row_id: str, text: str,
        min_confidence: float = MIN_CONFIDENCE, min_margin: float = MIN_MARGIN,
    ) -> DataFrame:
        """Adds ``intent, confidence, margin, is_confident, probabilities`` (4 decimals)."""
        names = F.array(*[F.lit(x) for x in self.labels])
        ranked = F.sort_array("chances", asc=False)
        top = F.element_at(ranked, 1)
        margin = top - F.element_at(ranked, 2) if len(self.labels) > 1 else top
        return (
            self.predict_proba(rows, row_id, text)
            .withColumn("intent", F.element_at(names, F.array_position("chances", F.array_max("chances")).cast("int")))
            .withColumn("is_confident", (top >= min_confidence) & (margin >= min_margin))
            .withColumn("confidence", F.round(top, 4))
            .withColumn("margin", F.round(margin, 4))
            .withColumn("probabilities", F.map_from_arrays(names, F.transform("chances", lambda x: F.round(x, 4))))
            .drop("chances")
        )

    def save(self, path: str) -> None:
        spark = self.vocabs[0].sparkSession
        PipelineModel(self.fitted).write().overwrite().save(f"{path}/folds")
        for n, vocab in enumerate(self.vocabs):
            vocab.write.mode("overwrite").parquet(f"{path}/vocab{n}")
        fx.save_specs(spark, self.specs, f"{path}/specs")
        rows = [(f, c, self.labels[c], a, b) for f, s in enumerate(self.sigmoids) for c, (a, b) in enumerate(s)]
        spark.createDataFrame(rows, "fold int, cls int, label string, slope double, shift double").write.mode(
            "overwrite").parquet(f"{path}/sigmoids")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "IntentModel":
        """A saved model with the settings it was fitted with."""
        specs = fx.load_specs(spark, f"{path}/specs")
        fitted = PipelineModel.load(f"{path}/folds").stages
        vocabs = [spark.read.parquet(f"{path}/vocab{n}") for n in range(len(specs))]
        rows = spark.read.parquet(f"{path}/sigmoids").orderBy("fold", "cls").collect()
        labels = [r["label"] for r in rows if r["fold"] == 0]
        sigmoids = [
            [(r["slope"], r["shift"]) for r in rows if r["fold"] == f] for f in range(len(fitted))
        ]
        return IntentModel(labels, vocabs, specs, [v.count() for v in vocabs], fitted, sigmoids)

