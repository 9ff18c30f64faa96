"""The intent classifier as Spark ML stages: an estimator and a transformer for ``Pipeline``, saved and loaded with it."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame

from caseflow.operators.models import MIN_CONFIDENCE, MIN_MARGIN, IntentClassifier, IntentModel


class _Columns(Params):
    rowIdCol = Param(Params._dummy(), "rowIdCol", "column that tells rows apart", TypeConverters.toString)
    textCol = Param(Params._dummy(), "textCol", "column of the text", TypeConverters.toString)
    minConfidence = Param(Params._dummy(), "minConfidence", "least probability of a sure answer", TypeConverters.toFloat)
    minMargin = Param(Params._dummy(), "minMargin", "least lead over the second answer of a sure one", TypeConverters.toFloat)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(rowIdCol="id", textCol="text", minConfidence=MIN_CONFIDENCE, minMargin=MIN_MARGIN)


class IntentEstimator(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``IntentClassifier`` on a label column."""

    labelCol = Param(Params._dummy(), "labelCol", "column of the label", TypeConverters.toString)
    c = Param(Params._dummy(), "c", "inverse strength of the regularisation", TypeConverters.toFloat)
    folds = Param(Params._dummy(), "folds", "number of calibration folds", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the folds", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, rowIdCol=None, textCol=None, labelCol=None, c=None, folds=None, seed=None, minConfidence=None, minMargin=None):
        super().__init__()
        self._setDefault(labelCol="label", c=IntentClassifier.c, folds=IntentClassifier.folds, seed=IntentClassifier.seed)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> "IntentTransformer":
        get = self.getOrDefault
        fitted = IntentClassifier(c=get("c"), folds=get("folds"), seed=get("seed")).fit(dataset, get("rowIdCol"), get("textCol"), get("labelCol"))
        return self._copyValues(IntentTransformer(fitted))


class IntentTransformer(Model, _Columns, MLReadable, MLWritable):
    """Adds ``intent, confidence, margin, is_confident, probabilities``."""

    def __init__(self, model: IntentModel | None = None) -> None:
        super().__init__()
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = self.getOrDefault
        return self.model.transform(dataset, get("rowIdCol"), get("textCol"), get("minConfidence"), get("minMargin"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, stage: IntentTransformer) -> None:
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.model.save(f"{path}/model")


class _Reader(MLReader):
    def load(self, path: str) -> IntentTransformer:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = IntentTransformer(IntentModel.load(self.sparkSession, f"{path}/model"))
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage
