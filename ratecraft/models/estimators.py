"""The rating models as Spark ML estimators, for ``CrossValidator``, ``ParamGridBuilder`` and pipelines.

    grid = ParamGridBuilder().addGrid(bias.regUser, [5.0, 15.0]).build()
    CrossValidator(estimator=bias, estimatorParamMaps=grid, evaluator=rmse(), foldCol="fold", parallelism=4)
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame

from ratecraft import ITEM, PREDICTION, RATING, USER
from ratecraft.models.bias import BiasModel
from ratecraft.models.factor import SvdppModel


def rmse() -> RegressionEvaluator:
    return RegressionEvaluator(predictionCol=PREDICTION, labelCol=RATING, metricName="rmse")


class RatingModel(Model):
    """Adds a prediction to (user_id, business_id, ...) rows; unknown users and items count as average."""

    def __init__(self, fitted=None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.fitted.predict(dataset)

    def copy(self, extra=None) -> RatingModel:
        other = super().copy(extra)
        other.fitted = self.fitted
        return other


class BiasEstimator(Estimator):
    epochs = Param(Params._dummy(), "epochs", "alternations of item and user offsets", TypeConverters.toInt)
    regItem = Param(Params._dummy(), "regItem", "weight that pulls item offsets to 0", TypeConverters.toFloat)
    regUser = Param(Params._dummy(), "regUser", "weight that pulls user offsets to 0", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, epochs: int = 10, regItem: float = 10.0, regUser: float = 15.0):
        super().__init__()
        self._setDefault(epochs=10, regItem=10.0, regUser=15.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RatingModel:
        model = BiasModel(self.getOrDefault("epochs"), self.getOrDefault("regItem"), self.getOrDefault("regUser"))
        return RatingModel(model.fit(dataset.select(USER, ITEM, RATING)))


class SvdppEstimator(Estimator):
    factors = Param(Params._dummy(), "factors", "numbers per user and item", TypeConverters.toInt)
    epochs = Param(Params._dummy(), "epochs", "passes over the ratings", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, factors: int = 20, epochs: int = 20):
        super().__init__()
        self._setDefault(factors=20, epochs=20)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> RatingModel:
        model = SvdppModel(factors=self.getOrDefault("factors"), epochs=self.getOrDefault("epochs"))
        return RatingModel(model.fit(dataset.select(USER, ITEM, RATING), RATING))
