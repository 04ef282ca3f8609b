"""The ranker and the text encoder as ``pyspark.ml`` stages (M06, M08, X06): Params, Pipelines, persistence.

``LambdaRanker`` takes a table with user, label and numeric feature columns, and an optional boolean column that marks validation
rows; its model adds the score. ``CatalogEncoder`` takes a catalog (rows marked as training items are what it learns from); its
model replaces the catalog by one row per item with its text features. Both are saved by the ML writers: Params as
metadata, trees as one JSON row, fitted vocabularies as Parquet tables.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plateau.config import RankerParams
from plateau.operators import ranker as RK
from plateau.operators import text as TX
from plateau.sources.io import feature_columns

_TYPES = {int: TypeConverters.toInt, float: TypeConverters.toFloat, tuple: TypeConverters.toListInt}


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, kind)


class _RankerShared(Params):
    featureCols = _param("featureCols", "feature columns; all numeric ones if not set", TypeConverters.toListString)
    userCol = _param("userCol", "user column", TypeConverters.toString)
    labelCol = _param("labelCol", "graded label column", TypeConverters.toString)
    predictionCol = _param("predictionCol", "column that the model adds", TypeConverters.toString)
    validationCol = _param("validationCol", "boolean column of the rows for early stopping; none if not set", TypeConverters.toString)
    seed = _param("seed", "seed of the row and feature samples", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(userCol="user_id", labelCol="label", predictionCol="score", seed=42)


for _name, _value in RankerParams().__dict__.items():
    setattr(_RankerShared, _name, _param(_name, f"ranker parameter {_name}", _TYPES[type(_value)]))


class LambdaRanker(_RankerShared, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Gradient-boosted LambdaRank (``ranker.fit_ranker``) as an Estimator."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._setDefault(**{k: list(v) if isinstance(v, tuple) else v for k, v in RankerParams().__dict__.items()})
        self._set(**self._input_kwargs)

    def params_of(self) -> RankerParams:
        got = {k: self.getOrDefault(k) for k in RankerParams().__dict__}
        return RankerParams(**{k: tuple(v) if isinstance(v, list) else v for k, v in got.items()})

    def _fit(self, dataset: DataFrame) -> "LambdaRankerModel":
        user, label = self.getOrDefault("userCol"), self.getOrDefault("labelCol")
        mark = self.getOrDefault("validationCol") if self.isSet("validationCol") else None
        feats = self.getOrDefault("featureCols") if self.isSet("featureCols") else \
            [c for c in feature_columns(dataset) if c not in {user, label, mark}]
        held = F.coalesce(F.col(mark), F.lit(False)) if mark else F.lit(False)
        res = RK.fit_ranker(dataset.filter(~held), dataset.filter(held) if mark else None, feats, self.params_of(), user=user, label=label,
                            seed=self.getOrDefault("seed"))
        return self._copyValues(LambdaRankerModel(res))


class _ModelWriter(MLWriter):
    def __init__(self, instance: "LambdaRankerModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        RK.save_model(self.instance.result, self.sparkSession, f"{path}/model", {"importance": self.instance.result.importance})


class _ModelReader(MLReader):
    def load(self, path: str) -> "LambdaRankerModel":
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        scorer, more = RK.load_model(self.sparkSession, f"{path}/model")
        model = LambdaRankerModel(RK.RankerResult(scorer, more["history"], more["best_round"], more["importance"]))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


class LambdaRankerModel(_RankerShared, Model, MLReadable, MLWritable):
    """Trees, history and gain importance of a fit; ``transform`` adds the score to every row."""

    def __init__(self, result: RK.RankerResult | None = None):
        super().__init__()
        self.result = result

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return RK.score_frame(dataset, self.result.scorer, self.getOrDefault("predictionCol"))

    @property
    def feature_importances(self) -> dict[str, float]:
        return self.result.importance

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _EncoderShared(Params):
    encoders = _param("encoders", "specs as JSON: [column, method, prefix, size] each", TypeConverters.toString)
    trainCol = _param("trainCol", "boolean column of the items to learn from; all if not set", TypeConverters.toString)
    labelCol = _param("labelCol", "label column of target encodings", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        specs = [[e.column, e.method, e.prefix, e.size] for e in TX.DEFAULT_ENCODERS]
        self._setDefault(encoders=json.dumps(specs), labelCol="label")

    def specs(self) -> tuple[TX.Encoder, ...]:
        return tuple(TX.Encoder(*x) for x in json.loads(self.getOrDefault("encoders")))


class CatalogEncoder(_EncoderShared, Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Text encodings of a catalog (``text.TextEncoder``) as an Estimator."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "CatalogEncoderModel":
        mark = self.getOrDefault("trainCol") if self.isSet("trainCol") else None
        train = dataset.filter(F.coalesce(F.col(mark), F.lit(False))) if mark else dataset
        label = self.getOrDefault("labelCol")
        keys = train.select("recipe_id", *([F.col(label).alias("label")] if label in dataset.columns else []))
        return self._copyValues(CatalogEncoderModel(TX.TextEncoder(self.specs()).fit(keys, dataset)))


class _EncoderWriter(MLWriter):
    def __init__(self, instance: "CatalogEncoderModel"):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.encoder.save(f"{path}/state")


class _EncoderReader(MLReader):
    def load(self, path: str) -> "CatalogEncoderModel":
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CatalogEncoderModel()
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        model.encoder = TX.TextEncoder.load(self.sparkSession, f"{path}/state", model.specs())
        return model


class CatalogEncoderModel(_EncoderShared, Model, MLReadable, MLWritable):
    """Fitted encodings; ``transform`` gives one row per item with its features."""

    def __init__(self, encoder: TX.TextEncoder | None = None):
        super().__init__()
        self.encoder = encoder

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.encoder.transform(dataset)

    def write(self) -> MLWriter:
        return _EncoderWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _EncoderReader()
