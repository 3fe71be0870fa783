"""End-to-end plans: inputs -> features -> forecasts -> labor inputs -> mart.

Every step returns a lazy DataFrame; nothing is collected. ``Workspace`` memoizes
the DataFrame objects of one run so that each stage is declared once.
The weekly inputs (sales, features) are written once per run under the
checkpoint folder (``spark.checkpoint.dir``) and read back: the raw scans and
joins run once, later stages and scalar subqueries read the small weekly
tables, and a lost executor recovers from files instead of rescanning the raw
data. ``persist=True`` does the same for the feature table and the mart.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.config import ForecastConfig, LaborConfig, MartConfig
from shiftwise.operators import evaluate, forecast, models, standards
from shiftwise.operators import mart as mart_op
from shiftwise.operators import schedule as schedule_op
from shiftwise.operators import split as split_op
from shiftwise.operators.features import create_features
from shiftwise.operators.prepare import prepare_modeling_data
from shiftwise.session import materialize, remove_folder, run_folder
from shiftwise.sources import fixtures


class Workspace:
    """All stages for one input folder, declared lazily and once."""

    def __init__(self, spark: SparkSession, sf_dir: str, fcfg: ForecastConfig = ForecastConfig(),
                 lcfg: LaborConfig = LaborConfig(), mcfg: MartConfig = MartConfig(),
                 mart_model: str | None = None, persist: bool = False,
                 materialize_inputs: bool = True, dept_grain: str = "type", inputs=None):
        """``inputs`` brings its own sales, stores, features and test (e.g. ``CsvInputs``) in place of the derived ones."""
        self.spark, self.sf_dir, self.inputs = spark, sf_dir, inputs
        self.dept_grain = dept_grain
        self.fcfg, self.lcfg, self.mcfg = fcfg, lcfg, mcfg
        self.mart_model = mart_model
        self.persist, self.materialize_inputs = persist, materialize_inputs
        self.run_id = uuid.uuid4().hex

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        return materialize(df, name, self.run_id)

    def _keep(self, df: DataFrame, name: str) -> DataFrame:
        return self._write(df, name) if self.persist else df

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        return self._write(df, name) if self.materialize_inputs or self.persist else df

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written under this run's folder and read back."""
        return self._write(df, name)

    def plan_on(self, forecast: DataFrame) -> None:
        """Build the labor plan and the mart on these forecast rows (before they are first asked for)."""
        self.__dict__["mart_forecast"] = self._stage(forecast, "mart_forecast")

    # inputs ---------------------------------------------------------------
    @cached_property
    def sales(self) -> DataFrame:
        own = self.inputs.sales() if self.inputs else fixtures.derive_sales(self.spark, self.sf_dir, self.dept_grain)
        return self._stage(own, "sales")

    @cached_property
    def stores(self) -> DataFrame:
        return self.inputs.stores() if self.inputs else fixtures.derive_stores(self.spark, self.sf_dir)

    @cached_property
    def features(self) -> DataFrame:
        own = self.inputs.features() if self.inputs else fixtures.derive_features(self.spark, self.sf_dir)
        return self._stage(own, "features")

    @cached_property
    def test(self) -> DataFrame:
        return self.inputs.test() if self.inputs else fixtures.derive_test(self.sales, self.fcfg.holdout_weeks)

    # modeling -------------------------------------------------------------
    @cached_property
    def modeling_table(self) -> DataFrame:
        return prepare_modeling_data(self.sales, self.stores, self.features)

    @cached_property
    def feature_table(self) -> DataFrame:
        ft = create_features(self.modeling_table, lags=self.fcfg.lags,
                             windows=self.fcfg.rolling_windows)
        return self._keep(ft, "feature_table")

    @cached_property
    def holdout_start(self):
        """max(date) - 12 weeks, taken on the weekly sales: the feature table is
        sales left-joined with unique lookups, so it has exactly the same dates,
        and the scalar subquery then reads the small written table instead of
        re-running the fill and window chain."""
        return split_op.holdout_start(self.sales, self.fcfg.holdout_weeks)

    @cached_property
    def split(self) -> split_op.Split:
        return split_op.time_split(self.feature_table, self.fcfg.holdout_weeks,
                                   start=self.holdout_start)

    # forecasts ------------------------------------------------------------
    @cached_property
    def naive_forecasts(self) -> DataFrame:
        return forecast.naive_forecasts(self.split.holdout)

    @cached_property
    def naive_metrics(self) -> DataFrame:
        return evaluate.model_metrics(self.naive_forecasts, self.split.start)

    @cached_property
    def naive_best(self) -> DataFrame:
        return evaluate.forecast_best(self.naive_forecasts, self.naive_metrics)

    @cached_property
    def prepared(self) -> models.Prepared:
        """Imputed train and holdout rows, written so that the median pass, the
        label moments and every fitting pass read files, and nothing stays cached."""
        train, holdout = self._write(self.split.train, "train"), self._write(self.split.holdout, "holdout")
        p = models.prepare(train, holdout)
        return models.Prepared(self._write(p.train, "train_imputed"), self._write(p.holdout, "holdout_imputed"), p.medians)

    @cached_property
    def ridge_forecasts(self) -> DataFrame:
        return models.ridge_forecast(self.prepared, self.fcfg)

    @cached_property
    def gbt_forecasts(self) -> DataFrame:
        return models.gbt_forecast(self.prepared, self.fcfg)

    @cached_property
    def model_forecasts(self) -> DataFrame:
        """Ridge and boosting forecasts stacked (fits both models)."""
        return self.ridge_forecasts.unionByName(self.gbt_forecasts)

    @cached_property
    def model_metrics(self) -> DataFrame:
        return evaluate.model_metrics(self.model_forecasts, self.split.start)

    @cached_property
    def model_best(self) -> DataFrame:
        return evaluate.forecast_best(self.model_forecasts, self.model_metrics)

    @cached_property
    def mart_forecast(self) -> DataFrame:
        """The forecast the labor plan is built on: the model with the lowest
        holdout WAPE, or the one named by ``mart_model``. Written once, since the
        schedule, the mart and the rollups all read it."""
        if self.mart_model is None:
            return self._stage(self.naive_best, "mart_forecast")
        return self._stage(self.naive_forecasts.where(F.col("model_name") == self.mart_model), "mart_forecast")

    # labor ----------------------------------------------------------------
    @cached_property
    def labor_standards(self) -> DataFrame:
        return standards.labor_standards(self.sales, self.lcfg)

    @cached_property
    def schedule(self) -> DataFrame:
        return schedule_op.plan_schedule(self.mart_forecast, self.labor_standards, self.lcfg)

    @cached_property
    def mart(self) -> DataFrame:
        m = mart_op.workforce_mart(self.mart_forecast, self.labor_standards, self.schedule, self.mcfg)
        return self._keep(m, "mart_workforce_dashboard")

    def release(self) -> None:
        """Delete the tables this run has written. Frames that read them end here."""
        remove_folder(self.spark, run_folder(self.spark, self.run_id))

    def tables(self) -> dict[str, DataFrame]:
        """The nine loaded tables plus the mart, under their published names."""
        return {
            "raw_train_sales": self.sales,
            "raw_features": self.features,
            "raw_stores": self.stores,
            "raw_test_sales": self.test,
            "analytics_forecast_output": self.mart_forecast,
            "analytics_model_comparison": self.naive_metrics,
            "analytics_model_metrics": self.naive_metrics,
            "analytics_labor_standards": self.labor_standards,
            "analytics_simulated_schedule": self.schedule,
            "mart_workforce_dashboard": self.mart,
        }
