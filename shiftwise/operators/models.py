"""Regression forecasts.

* median imputation of the numeric features, fitted on the training rows
  (exact interpolated median by distributed selection);
* one-hot encoding of store, dept, type and holiday from a category dictionary,
  where a value unseen in training sets nothing;
* ridge regression (L2, unpenalized intercept, no standardization) by MLlib, or
  by its normal equations with the widest category eliminated (``ridge``);
* gradient-boosted trees (``boosting``).

Only fitted parameters (medians, label moments, cuts, category counts, model
coefficients and trees) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftwise.config import CATEGORICAL_FEATURES, NUMERIC_FEATURES, ForecastConfig
from shiftwise.operators import ridge
from shiftwise.operators.boosting import BoostConfig, BoostedModel, fit_boosting, with_prediction
from shiftwise.operators.categories import category_dictionary, dense, onehot
from shiftwise.operators.forecast import score_model
from shiftwise.operators.selection import column_medians
from shiftwise.session import materialize

RIDGE = "Ridge Regression"
GBT = "Gradient Boosted Trees"


def fit_medians(train: DataFrame, cols=NUMERIC_FEATURES) -> DataFrame:
    """One row of per-column medians over the training rows."""
    return column_medians(train, cols)


def impute(df: DataFrame, medians: dict, cols=NUMERIC_FEATURES) -> DataFrame:
    """Adds ``<col>_imp``; the original columns stay as they are for the output."""
    return df.withColumns({f"{c}_imp": F.coalesce(F.col(c).cast("double"), F.lit(medians[c]))
                           for c in cols})


IMPUTED = [f"{c}_imp" for c in NUMERIC_FEATURES]


@dataclass
class Prepared:
    train: DataFrame
    holdout: DataFrame
    medians: dict

    @cached_property
    def dictionary(self) -> DataFrame:
        """The training rows' categories, written once: every row is joined to them."""
        return materialize(category_dictionary(self.train, CATEGORICAL_FEATURES), "categories")


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Rows in a fixed number of hash partitions by series, sorted inside each, so
    that row subsampling, and with it the forecast, is the same on any cluster."""
    return df.repartition(partitions, "store", "dept").sortWithinPartitions("store", "dept", "date")


def prepare(train: DataFrame, holdout: DataFrame, cols=NUMERIC_FEATURES) -> Prepared:
    """Impute both sides with medians fitted on train (model parameters)."""
    # a column with no value at all imputes to 0.0 instead of failing assembly
    medians = {c: (0.0 if v is None else v) for c, v in fit_medians(train, cols).first().asDict().items()}
    return Prepared(prepared_rows(train, medians, cols), prepared_rows(holdout, medians, cols), medians)


def prepared_rows(df: DataFrame, medians: dict, cols=NUMERIC_FEATURES) -> DataFrame:
    """Imputed values and categories as text beside the original columns."""
    return impute(df, medians, cols).withColumns({f"{c}_cat": F.col(c).cast("string") for c in CATEGORICAL_FEATURES})


def _indexers():
    """One multi-column indexer: all label counts in a single pass over the data."""
    return [StringIndexer(inputCols=[f"{c}_cat" for c in CATEGORICAL_FEATURES],
                          outputCols=[f"{c}_idx" for c in CATEGORICAL_FEATURES],
                          handleInvalid="keep", stringOrderType="alphabetAsc")]


def onehot_features(p: Prepared) -> DataFrame:
    """Holdout rows with the one-hot block, sparse (size, indices) and as an array (unseen values -> zeros)."""
    out = onehot(p.holdout, p.dictionary, CATEGORICAL_FEATURES)
    return out.select("store", "dept", "date", "onehot_size", "onehot_indices", dense().alias("onehot"))


def ridge_pipeline(train: DataFrame, cfg: ForecastConfig = ForecastConfig(),
                   label: str = "weekly_sales") -> Pipeline:
    """sklearn-style ridge: min ||y - Xw - b||^2 + alpha ||w||^2.

    Up to 4,096 features MLlib solves the normal equations (one distributed pass
    builds the Gram matrix, the small solve runs on the driver), beyond that it
    runs l-bfgs over the rows. Both minimize
    1/(2n)||.||^2 + regParam/2 ||w||^2 with the penalty divided by the label's
    population standard deviation, so regParam = alpha * std_pop(y) / n gives
    the closed-form ridge solution.
    """
    mom = train.agg(F.count(label).alias("n"), F.stddev_pop(label).alias("sd")).first()
    reg = cfg.ridge_alpha * (mom["sd"] or 0.0) / max(mom["n"], 1)
    enc = OneHotEncoder(inputCols=[f"{c}_idx" for c in CATEGORICAL_FEATURES],
                        outputCols=[f"{c}_vec" for c in CATEGORICAL_FEATURES], dropLast=True)
    asm = VectorAssembler(inputCols=[*IMPUTED, *[f"{c}_vec" for c in CATEGORICAL_FEATURES]],
                          outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction",
                          regParam=reg, elasticNetParam=0.0, standardization=False,
                          fitIntercept=True, solver="auto", maxIter=1000, tol=1e-10)
    return Pipeline(stages=[*_indexers(), enc, asm, lr])


def boost_config(cfg: ForecastConfig = ForecastConfig()) -> BoostConfig:
    return BoostConfig(rounds=cfg.gbt_rounds, step=cfg.gbt_step, depth=cfg.gbt_depth, min_weight=cfg.gbt_min_instances,
                       row_share=cfg.gbt_subsample, column_share=cfg.gbt_column_share, l2=cfg.gbt_l2, bins=cfg.gbt_bins,
                       seed=cfg.seed)


def fit_gbt(p: Prepared, cfg: ForecastConfig = ForecastConfig(), label: str = "weekly_sales") -> BoostedModel:
    return fit_boosting(p.train, IMPUTED, CATEGORICAL_FEATURES, p.dictionary, label, ["store", "dept", "date"], boost_config(cfg))


def fit(pipeline: Pipeline, train: DataFrame, cfg: ForecastConfig = ForecastConfig()) -> PipelineModel:
    """Fit with the training rows in their fixed partitions, persisted (memory,
    spilling to disk) for the iterative passes and released afterwards."""
    cached = spread(train, cfg.fit_partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(cached)
    finally:
        cached.unpersist()


def forecast_with(model: PipelineModel, holdout: DataFrame, model_name: str) -> DataFrame:
    return score_model(model.transform(holdout), model_name, "prediction")


def ridge_forecast(p: Prepared, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    return forecast_with(fit(ridge_pipeline(p.train, cfg), p.train, cfg), p.holdout, RIDGE)


def fit_normal_ridge(p: Prepared, cfg: ForecastConfig = ForecastConfig(), label: str = "weekly_sales") -> ridge.RidgeModel:
    return ridge.fit_ridge(p.train, IMPUTED, CATEGORICAL_FEATURES, p.dictionary, label, cfg.ridge_alpha)


def normal_ridge_forecast(p: Prepared, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    fitted = ridge.with_prediction(fit_normal_ridge(p, cfg), p.holdout, CATEGORICAL_FEATURES)
    return score_model(fitted, RIDGE, "prediction")


def gbt_forecast(p: Prepared, cfg: ForecastConfig = ForecastConfig()) -> DataFrame:
    return score_model(with_prediction(fit_gbt(p, cfg), p.holdout, p.dictionary), GBT, "prediction")
