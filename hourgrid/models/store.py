"""Choosing, saving and loading a forecaster."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from hourgrid.config import BoostedTreeParams, FeatureSpec, TrendSeasonalParams
from hourgrid.models.boosted_trees import BoostedTreeModel, fit_boosted_trees
from hourgrid.models.trend_seasonal import (
    Layout,
    TrendSeasonalModel,
    fit_trend_seasonal,
)
from hourgrid.schemas import MODEL_METADATA

# The strategy names users pass, and the model each one selects.
STRATEGIES = {
    "Prophet": "trend_seasonal",
    "XGBoost": "boosted_trees",
    "trend_seasonal": "trend_seasonal",
    "boosted_trees": "boosted_trees",
}


@dataclass(frozen=True)
class Forecaster:
    """A fitted model with what scoring needs to know about it."""

    model_type: str
    model: TrendSeasonalModel | BoostedTreeModel
    feature_columns: tuple[str, ...]
    target_column: str
    #: How the features were made that the model was fitted on; inference makes them alike.
    spec: FeatureSpec = field(default_factory=FeatureSpec)

    @property
    def serving_columns(self) -> tuple[str, ...]:
        """The columns that inference has to make for this model."""
        key = (self.spec.key, self.spec.time)
        return (*key, *(name for name in self.feature_columns if name not in key))

    def forecast(self, features: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        return self.model.forecast(features, keep)

    def save(self, spark: SparkSession, path: str) -> None:
        layout = None
        if isinstance(self.model, BoostedTreeModel):
            self.model.save(spark, f"{path}/trees")
        else:
            layout = self.model.layout.to_json()
            self.model.coefficients.write.mode("overwrite").parquet(
                f"{path}/coefficients"
            )
        features, spec = list(self.feature_columns), self.spec.to_json()
        row = (self.model_type, features, self.target_column, layout, spec)
        # The metadata is written last: a folder with metadata is a complete model.
        spark.createDataFrame([row], MODEL_METADATA).coalesce(1).write.mode(
            "overwrite"
        ).json(f"{path}/metadata")


def model_type_of(strategy: str) -> str:
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown model strategy: {strategy}")
    return STRATEGIES[strategy]


def fit_forecaster(
    strategy: str,
    train: DataFrame,
    feature_columns: Sequence[str] = (),
    hyperparameters: Mapping[str, Any] | None = None,
    target: str = "consumption_kwh",
    spec: FeatureSpec | None = None,
) -> Forecaster:
    model_type = model_type_of(strategy)
    settings = hyperparameters or {}
    model: TrendSeasonalModel | BoostedTreeModel
    if model_type == "boosted_trees":
        trees = BoostedTreeParams.from_mapping(settings)
        model = fit_boosted_trees(train, feature_columns, trees, target)
    else:
        params = TrendSeasonalParams.from_mapping(settings)
        model = fit_trend_seasonal(train, params, target)
        feature_columns = model.layout.regressors
    return Forecaster(model_type, model, tuple(feature_columns), target, spec or FeatureSpec())


def load_forecaster(spark: SparkSession, path: str) -> Forecaster:
    try:
        metadata = spark.read.schema(MODEL_METADATA).json(f"{path}/metadata").first()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"No model found in {path}") from error
        raise
    if metadata is None:
        raise FileNotFoundError(f"No model found in {path}")
    features = tuple(metadata.feature_columns)
    model: TrendSeasonalModel | BoostedTreeModel
    if metadata.model_type == "boosted_trees":
        if not features:
            raise ValueError("The stored model names no input columns")
        model = BoostedTreeModel.load(spark, f"{path}/trees", features)
    else:
        model = TrendSeasonalModel(
            spark.read.parquet(f"{path}/coefficients"), Layout.from_json(metadata.layout)
        )
    spec = FeatureSpec.from_json(metadata.feature_spec) if metadata.feature_spec else FeatureSpec()
    return Forecaster(metadata.model_type, model, features, metadata.target_column, spec)
