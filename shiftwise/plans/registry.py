"""Query registry: name -> (Spark plan, reference SQL, edge rounding).

Each Spark plan takes a ``Workspace`` and returns a lazy DataFrame over the
whole input tables. ``sql`` is the DuckDB text the correctness gate runs on the
same Parquet files (None = rows-only check). Floating-point sums depend on
summation order, so aggregated double columns are rounded at the query edge,
identically on both sides (``round``); row-level values are compared unrounded.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftwise.config import (CATEGORICAL_FEATURES, EXTERNAL_COLS, ForecastConfig, LAGS, MARKDOWN_COLS, NUMERIC_FEATURES,
                              REQUIRED_MODEL_COLS)
from shiftwise.functions.columns import bool_to_int, slug
from shiftwise.operators import dashboard, evaluate, mart, models, questions, ridge, rollups, validate
from shiftwise.operators.prepare import join_inputs
from shiftwise.operators.split import split_summary
from shiftwise.operators.standards import dept_stats, volume_cutoffs
from shiftwise.plans import load, sql_api
from shiftwise.plans.colocated import colocated_base
from shiftwise.plans.forecasting import run_forecast
from shiftwise.plans.oracle import with_ctes
from shiftwise.plans.pipeline import Workspace
from shiftwise.session import run_folder
from shiftwise.sources import files, loader, schemas
from shiftwise.sources.csv_inputs import CsvInputs, RejectedRows, write_inputs
from shiftwise.sources.fixtures import DEPT_BY_TYPE


#: Boosting in the registered queries: 60 rounds at 0.1; the library's default is the full 2,000 at 0.01.
REGISTERED = ForecastConfig(gbt_rounds=60, gbt_step=0.1)


@dataclass
class Query:
    name: str
    plan: Callable[[Workspace], DataFrame]
    sql: str | None = None  # final SELECT; the CTEs are added by oracle_text
    rounding: dict = field(default_factory=dict)
    ops: str = ""
    grain: str = "type"


def _round_spark(df: DataFrame, rounding: dict) -> DataFrame:
    if not rounding:
        return df
    return df.withColumns({c: F.round(f"`{c}`", d) for c, d in rounding.items()})


def _round_sql(sql: str, rounding: dict) -> str:
    if not rounding:
        return sql
    repl = ", ".join(f'round("{c}", {d}) AS "{c}"' for c, d in rounding.items())
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) q"


_REGISTRY: dict[str, Query] = {}


def register(name, plan, select=None, rounding=None, ops="", grain="type"):
    """``select`` is the final SELECT over the shared CTEs (``plans.oracle``)."""
    _REGISTRY[name] = Query(name, plan, select, rounding or {}, ops, grain)


#: Sums of weekly sales and of 4-week means have up to 6 decimals; 4 would fall on ties.
_SALES = {"actual_weekly_sales", "forecast_weekly_sales", "forecast_error", "abs_forecast_error"}


def sums(*cols, digits=4):
    return {c: 6 if c in _SALES else digits for c in cols}


def ratios(*cols, digits=9):
    return {c: digits for c in cols}


def grouped(keys: tuple, terms: dict, tail: str = "") -> str:
    """SELECT keys, terms FROM mart GROUP BY keys."""
    named = ", ".join([*keys, *(f"{expr} AS {name}" for name, expr in terms.items())])
    return f"SELECT {named} FROM mart GROUP BY {', '.join(keys)} {tail}"


def summed(*cols: str) -> dict:
    return {c: f"sum({c})" for c in cols}


def shared(x: str, y: str) -> str:
    return f"sum({x}) / NULLIF(sum({y}), 0)"


KEYS = ("store", "dept", "date")
_lag_cols = [f"lag_{n}" for n in LAGS]

# --- inputs and sources (A1, A3, A4) ------------------------------------------------
register("input_sales", lambda w: w.sales,
         "SELECT store, dept, date, weekly_sales, is_holiday FROM sales", ops="fixtures")
register("input_stores", lambda w: w.stores, "SELECT store, type, size FROM stores", ops="fixtures")
register("input_features", lambda w: w.features, "SELECT * FROM features", ops="fixtures")
register("input_test", lambda w: w.test, "SELECT * FROM test_keys", ops="fixtures")

# --- preparation (C1-C5, D1-D2, M1) ------------------------------------------------
register("join_sales_stores", lambda w: join_inputs(w.sales, w.stores, w.features)
         .select("store", "dept", "date", "weekly_sales", "is_holiday", "type", "size"),
         "SELECT store, dept, date, weekly_sales, is_holiday, type, size FROM joined", ops="D1")
register("modeling_table", lambda w: w.modeling_table, "SELECT * FROM modeling", ops="M1 D2")
register("sales_capped", lambda w: w.modeling_table.select(*KEYS, "weekly_sales", "weekly_sales_original"),
         "SELECT store, dept, date, weekly_sales, weekly_sales_original FROM modeling", ops="C1 C2")
register("markdown_fill", lambda w: w.modeling_table.select(*KEYS, *MARKDOWN_COLS),
         f"SELECT store, dept, date, {', '.join(MARKDOWN_COLS)} FROM modeling", ops="C3")
register("fill_external", lambda w: w.modeling_table.select(*KEYS, *EXTERNAL_COLS),
         f"SELECT store, dept, date, {', '.join(EXTERNAL_COLS)} FROM modeling", ops="C4 W4")

# --- features and split (F1-F3, W1-W3, M2, M3, C5, C7) ------------------------------
register("lag_features", lambda w: w.feature_table.select(*KEYS, *_lag_cols),
         f"SELECT store, dept, date, {', '.join(_lag_cols)} FROM feat", ops="W1")
register("rolling_features", lambda w: w.feature_table.select(*KEYS, "rolling_4_mean", "rolling_13_mean"),
         "SELECT store, dept, date, rolling_4_mean, rolling_13_mean FROM feat", ops="W2 W3")
register("calendar_features", lambda w: w.feature_table.select(
    *KEYS, "year", "month", "weekofyear", "quarter", "is_december"),
         "SELECT store, dept, date, year, month, weekofyear, quarter, is_december FROM feat",
         ops="F1 F2 F3")
register("feature_table", lambda w: w.feature_table, "SELECT * FROM feat", ops="M2")
register("model_frame", lambda w: w.split.train.unionByName(w.split.holdout)
         .select(*KEYS, "weekly_sales", *REQUIRED_MODEL_COLS),
         f"SELECT store, dept, date, weekly_sales, {', '.join(REQUIRED_MODEL_COLS)} FROM model_df",
         ops="C5")
register("split_summary", lambda w: split_summary(w.feature_table, w.fcfg.holdout_weeks,
                                                  start=w.holdout_start),
         """SELECT 'train' AS split, count(*) AS n_rows, min(date) AS first_date, max(date) AS last_date,
                   (SELECT holdout_start FROM bounds) AS holdout_start FROM train
            UNION ALL
            SELECT 'holdout', count(*), min(date), max(date), (SELECT holdout_start FROM bounds)
            FROM holdout""", ops="M3 G3 C7 D6")

# --- forecasts and evaluation (B5, M9-M13, U1, A3) ----------------------------------
register("forecast_output", lambda w: w.mart_forecast, "SELECT * FROM mart_forecast", ops="B5 M9 M10")
register("forecast_all_models", lambda w: w.naive_forecasts, "SELECT * FROM forecasts", ops="U1")
register("forecast_errors", lambda w: w.naive_forecasts.select(
    "model_name", *KEYS, "actual_weekly_sales", "forecast_weekly_sales", "forecast_error",
    "abs_forecast_error", "forecast_variance_pct"),
         """SELECT model_name, store, dept, date, actual_weekly_sales, forecast_weekly_sales,
                   forecast_error, abs_forecast_error, forecast_variance_pct FROM forecasts""",
         ops="M10")
_metric_round = {"mae": 6, "wape": 9}
register("model_metrics_naive", lambda w: w.naive_metrics, "SELECT * FROM metrics", _metric_round,
         ops="M11 G4 G5")
register("bq_model_comparison", lambda w: evaluate.model_comparison(w.naive_metrics),
         "SELECT * FROM metrics ORDER BY wape", _metric_round, ops="K4 M13 B7")
register("best_model", lambda w: evaluate.best_model(w.naive_metrics),
         "SELECT best_model FROM best", ops="T2 M12")
register("forecast_best", lambda w: w.naive_best,
         "SELECT * FROM forecasts WHERE model_name = (SELECT best_model FROM best)", ops="M12")
register("model_slug", lambda w: w.naive_forecasts.groupBy("model_name")
         .agg(F.count(F.lit(1)).alias("row_count")).withColumn("model_slug", slug("model_name")),
         """SELECT model_name, count(*) AS row_count,
                   lower(regexp_replace(model_name, '[ -]', '_', 'g')) AS model_slug
            FROM forecasts GROUP BY model_name""", ops="A3")
register("normalize_bool", lambda w: w.mart_forecast.select(
    *KEYS, bool_to_int("is_holiday").alias("is_holiday")),
         """SELECT store, dept, date,
                   CASE WHEN coalesce(lower(CAST(is_holiday AS VARCHAR)) IN ('true', '1'), false)
                        THEN 1 ELSE 0 END AS is_holiday
            FROM mart_forecast""", ops="B3 B4")

# --- labor inputs (G1, G2, L1-L14) --------------------------------------------------
register("dept_stats", lambda w: dept_stats(w.sales), "SELECT * FROM dept_stats",
         {"median_weekly_sales": 6, "avg_weekly_sales": 6}, ops="G1 L1")
register("volume_cutoffs", lambda w: volume_cutoffs(dept_stats(w.sales), w.lcfg),
         "SELECT * FROM cutoffs", {"low_cutoff": 8, "high_cutoff": 8}, ops="G2")
register("labor_standards", lambda w: w.labor_standards, "SELECT * FROM standards", ops="L2 L3 L4")
register("labor_schedule", lambda w: w.schedule, "SELECT * FROM schedule", ops="L5-L14 D3")

# --- mart (R1-R20) ------------------------------------------------------------------
def _base(w):
    return mart.mart_base(w.mart_forecast, w.labor_standards, w.schedule)


register("mart_base", _base, "SELECT * FROM mart_base", ops="R1 D4 D5 B6 B8")
register("mart_base_colocated", colocated_base, "SELECT * FROM mart_base", ops="D4 D5")
register("mart_labor", lambda w: mart.mart_labor(_base(w)), "SELECT * FROM mart_labor", ops="R2-R4")
register("mart_gap", lambda w: mart.mart_gap(mart.mart_labor(_base(w)), w.mcfg),
         "SELECT * FROM mart_gap", ops="R5-R11")
register("mart_scored", lambda w: mart.mart_scored(mart.mart_gap(mart.mart_labor(_base(w)), w.mcfg), w.mcfg),
         "SELECT * FROM mart_scored", ops="R12-R15")
register("mart_workforce", lambda w: w.mart, "SELECT * FROM mart", ops="R16-R20")

# --- rollups and business questions (K1-K8) -----------------------------------------
_sw = sums("actual_weekly_sales", "forecast_weekly_sales", "required_labor_hours",
           "scheduled_labor_hours", "available_labor_hours", "labor_gap_hours",
           "overtime_risk_hours", "estimated_overtime_cost")
_sw.update(ratios("avg_coverage_pct", "avg_site_readiness_score"))
register("mart_store_week", lambda w: rollups.store_week_summary(w.mart),
         grouped(("week_date", "store", "store_type"), {
             **summed(*rollups.STORE_WEEK_SUMS), "avg_coverage_pct": "avg(coverage_pct)",
             "avg_site_readiness_score": "avg(site_readiness_score)",
             "at_risk_dept_count": "count(*) FILTER (WHERE overtime_risk_flag = 'At Risk')"}),
         _sw, ops="K1 G7 G8 G9 G11")
_acc = sums("actual_weekly_sales", "forecast_weekly_sales", "abs_forecast_error")
_acc.update(ratios("wape", "forecast_bias_pct"))
register("mart_accuracy_summary", lambda w: rollups.forecast_accuracy_summary(w.mart),
         grouped(("store", "dept", "store_type"), {
             **summed("actual_weekly_sales", "forecast_weekly_sales", "abs_forecast_error"),
             "wape": shared("abs_forecast_error", "actual_weekly_sales"),
             "forecast_bias_pct": shared("forecast_error", "actual_weekly_sales")}), _acc, ops="K2 G5 G6")
_AT_RISK_SQL = f"SELECT {', '.join(rollups.AT_RISK_COLUMNS)} FROM mart WHERE overtime_risk_hours > 0"
register("mart_top_at_risk", lambda w: rollups.top_at_risk(w.mart),
         _AT_RISK_SQL + " ORDER BY estimated_overtime_cost DESC, store, dept, week_date",
         ops="K3 C6 T5")
_ot = sums("total_overtime_risk_hours", "total_estimated_overtime_cost")
_ot.update(ratios("avg_site_readiness_score"))
register("bq_top_overtime_stores", lambda w: questions.top_overtime_stores(w.mart),
         grouped(("store", "store_type"), {
             "total_overtime_risk_hours": "sum(overtime_risk_hours)",
             "total_estimated_overtime_cost": "sum(estimated_overtime_cost)",
             "avg_site_readiness_score": "avg(site_readiness_score)"},
             "ORDER BY total_estimated_overtime_cost DESC NULLS LAST, store, store_type LIMIT 10"),
         _ot, ops="K5 T3")
register("bq_top_at_risk_weeks", lambda w: questions.top_at_risk_weeks(w.mart),
         _AT_RISK_SQL + " ORDER BY estimated_overtime_cost DESC NULLS LAST, store, dept, week_date LIMIT 20",
         ops="K6 T3")
_da = sums("actual_weekly_sales", "forecast_weekly_sales", "abs_forecast_error")
_da.update(ratios("wape"))
register("bq_dept_accuracy", lambda w: questions.dept_accuracy(w.mart_forecast),
         grouped(("dept",), {
             **summed("actual_weekly_sales", "forecast_weekly_sales", "abs_forecast_error"),
             "wape": shared("abs_forecast_error", "actual_weekly_sales")},
             "ORDER BY wape DESC NULLS LAST, dept LIMIT 15"), _da, ops="K7")
_wt = sums("required_labor_hours", "available_labor_hours", "labor_gap_hours",
           "overtime_risk_hours", "estimated_overtime_cost")
register("bq_weekly_trend", lambda w: questions.weekly_trend(w.mart),
         grouped(("week_date",), summed(*questions.WEEKLY_SUMS), "ORDER BY week_date"), _wt, ops="K8 X3 T4")

# --- dashboard datasets (X1-X10) ----------------------------------------------------
_KPI_SQL = """SELECT count(*) AS row_count, sum(actual_weekly_sales) AS actual_weekly_sales,
                   sum(forecast_weekly_sales) AS forecast_weekly_sales,
                   sum(abs_forecast_error) / NULLIF(sum(actual_weekly_sales), 0) AS wape,
                   sum(required_labor_hours) AS required_labor_hours,
                   sum(available_labor_hours) AS available_labor_hours,
                   sum(labor_gap_hours) AS labor_gap_hours,
                   sum(overtime_risk_hours) AS overtime_risk_hours,
                   sum(estimated_overtime_cost) AS estimated_overtime_cost,
                   avg(site_readiness_score) AS avg_site_readiness_score
            FROM mart"""
_kpi = sums("actual_weekly_sales", "forecast_weekly_sales", "required_labor_hours",
            "available_labor_hours", "labor_gap_hours", "overtime_risk_hours", "estimated_overtime_cost")
_kpi.update(ratios("wape", "avg_site_readiness_score"))
register("kpi_overview", lambda w: dashboard.kpi_overview(w.mart), _KPI_SQL, _kpi, ops="X1")
DRILL = {"store_type": ["A"], "site_readiness_status": ["Watch", "At Risk"]}
register("kpi_drilldown", lambda w: dashboard.kpi_drilldown(w.mart, **DRILL),
         _KPI_SQL + " WHERE store_type IN ('A') AND site_readiness_status IN ('Watch', 'At Risk')",
         _kpi, ops="X6")
#: The seven filters of the drill-down, each alone, and some together.
SELECTIONS = {
    "store": {"store": [1, 5, 12]}, "department": {"dept": [2, 3]}, "store type": {"store_type": ["B", "C"]},
    "week": {"week_date": ["2001-08-13", "2001-09-03", "2001-10-22"]}, "holiday": {"is_holiday": 1},
    "readiness": {"site_readiness_status": ["Watch", "At Risk"]}, "overtime": {"overtime_risk_flag": "At Risk"},
    "stores of type A at risk": {"store_type": "A", "is_holiday": 0, "overtime_risk_flag": "At Risk"},
}


def _selections_sql() -> str:
    def listed(value) -> str:
        return ", ".join(repr(v) for v in (value if isinstance(value, list) else [value]))

    parts = [f"SELECT '{name}' AS selection, * FROM mart WHERE " + " AND ".join(f"{c} IN ({listed(v)})" for c, v in f.items())
             for name, f in SELECTIONS.items()]
    kpis = _KPI_SQL.removeprefix("SELECT ").removesuffix("FROM mart")
    return f"SELECT selection, {kpis} FROM ({' UNION ALL '.join(parts)}) GROUP BY selection"


register("kpi_drilldown_filters", lambda w: dashboard.drilldown_report(w.mart, SELECTIONS), _selections_sql(), _kpi, ops="X6")
_st = sums("actual_weekly_sales", "forecast_weekly_sales", "forecast_error")
_st.update(ratios("wape", "variance_pct"))
register("kpi_sales_trend", lambda w: dashboard.sales_trend(w.mart),
         """SELECT week_date, sum(actual_weekly_sales) AS actual_weekly_sales,
                   sum(forecast_weekly_sales) AS forecast_weekly_sales,
                   sum(forecast_error) AS forecast_error,
                   sum(abs_forecast_error) / NULLIF(sum(actual_weekly_sales), 0) AS wape,
                   sum(forecast_error) / NULLIF(sum(forecast_weekly_sales), 0) AS variance_pct
            FROM mart GROUP BY week_date""", _st, ops="X2")
register("labor_gap_heatmap", lambda w: dashboard.labor_gap_heatmap(w.mart),
         """SELECT store, dept, sum(labor_gap_hours) AS labor_gap_hours,
                   sum(overtime_risk_hours) AS overtime_risk_hours
            FROM mart GROUP BY store, dept""", sums("labor_gap_hours", "overtime_risk_hours"), ops="X4")
DEPTS = tuple(sorted(DEPT_BY_TYPE.values()))
register("labor_gap_heatmap_wide", lambda w: dashboard.labor_gap_heatmap_wide(w.mart, list(DEPTS)),
         grouped(("store",), {f'"{d}"': f"sum(labor_gap_hours) FILTER (WHERE dept = {d})" for d in DEPTS}),
         sums(*map(str, DEPTS)), ops="X4 pivot")
register("labor_plan_by_recommendation", lambda w: dashboard.labor_plan_by_recommendation(w.mart),
         """SELECT recommendation, count(*) AS row_count,
                   sum(required_labor_hours) AS required_labor_hours,
                   sum(available_labor_hours) AS available_labor_hours,
                   sum(labor_gap_hours) AS labor_gap_hours,
                   sum(overtime_risk_hours) AS overtime_risk_hours,
                   sum(estimated_overtime_cost) AS estimated_overtime_cost
            FROM mart GROUP BY recommendation""",
         sums("required_labor_hours", "available_labor_hours", "labor_gap_hours",
              "overtime_risk_hours", "estimated_overtime_cost"), ops="X5")
_he = ratios("avg_forecast_weekly_sales", "avg_required_labor_hours", "avg_labor_gap_hours",
             "avg_site_readiness_score", digits=6)
_he.update(sums("overtime_risk_hours"))
register("kpi_holiday_effect", lambda w: dashboard.holiday_effect(w.mart),
         """SELECT is_holiday, count(*) AS row_count,
                   avg(forecast_weekly_sales) AS avg_forecast_weekly_sales,
                   avg(required_labor_hours) AS avg_required_labor_hours,
                   avg(labor_gap_hours) AS avg_labor_gap_hours,
                   sum(overtime_risk_hours) AS overtime_risk_hours,
                   CAST(sum(CASE WHEN overtime_risk_flag = 'At Risk' THEN 1 ELSE 0 END) AS BIGINT)
                     AS at_risk_rows,
                   avg(site_readiness_score) AS avg_site_readiness_score
            FROM mart GROUP BY is_holiday""", _he, ops="X7")
register("kpi_lowest_readiness", lambda w: dashboard.lowest_readiness(w.mart),
         """SELECT store, store_type, avg(site_readiness_score) AS avg_site_readiness_score,
                   count(*) AS row_count
            FROM mart GROUP BY store, store_type
            ORDER BY avg_site_readiness_score ASC NULLS LAST, store LIMIT 10""",
         ratios("avg_site_readiness_score"), ops="X8")
register("kpi_largest_gaps", lambda w: dashboard.largest_gaps(w.mart),
         """SELECT week_date, store, dept, store_type, required_labor_hours, available_labor_hours,
                   labor_gap_hours, recommendation
            FROM mart ORDER BY labor_gap_hours DESC NULLS LAST, store, dept, week_date LIMIT 20""",
         ops="X9")
register("kpi_readiness_mix", lambda w: dashboard.readiness_mix(w.mart),
         """SELECT site_readiness_status, count(*) AS row_count,
                   avg(site_readiness_score) AS avg_site_readiness_score
            FROM mart GROUP BY site_readiness_status""", ratios("avg_site_readiness_score"), ops="X10")

# --- validation (V1-V4) -------------------------------------------------------------
register("validate_counts", lambda w: validate.row_counts(w.tables()),
         """SELECT 'raw_train_sales' AS table_name, count(*) AS row_count FROM sales
            UNION ALL SELECT 'raw_features', count(*) FROM features
            UNION ALL SELECT 'raw_stores', count(*) FROM stores
            UNION ALL SELECT 'raw_test_sales', count(*) FROM test_keys
            UNION ALL SELECT 'analytics_forecast_output', count(*) FROM mart_forecast
            UNION ALL SELECT 'analytics_model_comparison', count(*) FROM metrics
            UNION ALL SELECT 'analytics_model_metrics', count(*) FROM metrics
            UNION ALL SELECT 'analytics_labor_standards', count(*) FROM standards
            UNION ALL SELECT 'analytics_simulated_schedule', count(*) FROM schedule
            UNION ALL SELECT 'mart_workforce_dashboard', count(*) FROM mart""", ops="V1 G10")
register("validate_sample", lambda w: validate.sample_rows(w.mart),
         "SELECT * FROM mart ORDER BY store, dept, week_date LIMIT 20", ops="V2 T6")
register("validate_fanout", lambda w: validate.fanout_check(w.mart_forecast, w.labor_standards,
                                                            w.schedule, w.mart),
         """SELECT 'standards_duplicate_depts' AS check_name,
                   (SELECT count(*) FROM (SELECT dept FROM standards GROUP BY dept HAVING count(*) > 1))
                     AS value
            UNION ALL SELECT 'schedule_duplicate_keys',
                   (SELECT count(*) FROM (SELECT store, dept, date FROM schedule
                                          GROUP BY store, dept, date HAVING count(*) > 1))
            UNION ALL SELECT 'forecast_rows', (SELECT count(*) FROM mart_forecast)
            UNION ALL SELECT 'mart_rows', (SELECT count(*) FROM mart)""", ops="V3")
register("validate_unmatched", lambda w: validate.unmatched_rows(w.mart),
         """SELECT count(*) AS mart_rows,
                   count(*) FILTER (WHERE volume_tier IS NULL) AS rows_without_standard,
                   count(*) FILTER (WHERE callout_rate IS NULL) AS rows_without_schedule,
                   count(*) FILTER (WHERE target_sales_per_labor_hour = 0) AS rows_with_zero_target,
                   count(*) FILTER (WHERE actual_weekly_sales = 0) AS rows_with_zero_actual,
                   count(*) FILTER (WHERE forecast_weekly_sales = 0) AS rows_with_zero_forecast
            FROM mart""", ops="V4")
# --- MLlib forecasts (M4-M9, M11-M14) ----------------------------------------------
register("impute_median", lambda w: models.fit_medians(w.split.train),
         "SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in NUMERIC_FEATURES)
         + " FROM train", {c: 6 for c in NUMERIC_FEATURES}, ops="M4")
def _onehot(w):
    rows = models.onehot_features(w.prepared)
    return rows.select(*KEYS, F.col("onehot_size").cast("long").alias("onehot_size"),
                       F.array_join("onehot_indices", ",").alias("onehot_indices"))


def _onehot_sql() -> str:
    """Places of the ones: a category's rank within its column, after the columns before it."""
    values = {c: f"CAST({c} AS VARCHAR)" for c in CATEGORICAL_FEATURES}
    counted = {c: f"(SELECT count(DISTINCT {v}) FROM train)" for c, v in values.items()}
    places, before = [], "0"
    for c, v in values.items():
        rank = f"(SELECT count(DISTINCT {v}) FROM train t WHERE CAST(t.{c} AS VARCHAR) < CAST(h.{c} AS VARCHAR))"
        places.append(f"CASE WHEN CAST(h.{c} AS VARCHAR) IN (SELECT {v} FROM train) THEN {before} + {rank} END")
        before += f" + {counted[c]}"
    return (f"SELECT store, dept, date, CAST({before} AS BIGINT) AS onehot_size, "
            f"concat_ws(',', {', '.join(places)}) AS onehot_indices FROM holdout h")


register("onehot_holdout", _onehot, _onehot_sql(), ops="M5 M6")
register("forecast_ridge", lambda w: w.ridge_forecasts, None, ops="M6 M7 M9 M10")
register("forecast_ridge_normal", lambda w: models.normal_ridge_forecast(w.prepared, w.fcfg), None, ops="M7 M9 M10")


def _ridge_gram(w):
    cells = ridge.gram(w.prepared.train, models.IMPUTED, CATEGORICAL_FEATURES, w.prepared.dictionary, "weekly_sales")
    return cells.withColumn("cosine", F.round("cosine", 6) + F.lit(0.0))


def _ridge_residuals(w):
    model = models.fit_normal_ridge(w.prepared, w.fcfg)
    gaps = ridge.residuals(model, w.prepared.train, CATEGORICAL_FEATURES, "weekly_sales", w.fcfg.ridge_alpha)
    return gaps.select("feature", (F.col("gap") < 1e-9).alias("solved"))


def _ridge_gram_sql() -> str:
    """Every training row as (feature, value) cells, joined with itself."""
    imputed = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM train), 0.0) AS {c}"
                        for c in NUMERIC_FEATURES)
    kinds = ", ".join(f"'{c}=' || CAST({c} AS VARCHAR) AS {c}_kind" for c in CATEGORICAL_FEATURES)
    numbers = [f"SELECT id, '{c}' AS feature, {c} - avg({c}) OVER () AS x FROM x" for c in [*NUMERIC_FEATURES, "weekly_sales"]]
    ones = [f"SELECT id, {c}_kind, 1.0::DOUBLE FROM x WHERE {c}_kind IS NOT NULL" for c in CATEGORICAL_FEATURES]
    return f"""SELECT feature_a, feature_b, round(total / sqrt(left_square) / sqrt(right_square), 6) + 0.0 AS cosine
        FROM (WITH x AS (SELECT row_number() OVER () AS id, {imputed}, {kinds}, weekly_sales FROM train),
                   cells AS ({' UNION ALL '.join(numbers + ones)}),
                   sums AS (SELECT p.feature AS feature_a, q.feature AS feature_b, sum(p.x * q.x) AS total
                            FROM cells p JOIN cells q ON p.id = q.id AND p.feature <= q.feature
                            GROUP BY p.feature, q.feature)
              SELECT s.*, l.total AS left_square, r.total AS right_square FROM sums s
              JOIN sums l ON l.feature_a = s.feature_a AND l.feature_b = s.feature_a
              JOIN sums r ON r.feature_a = s.feature_b AND r.feature_b = s.feature_b) q
        WHERE total <> 0"""


register("ridge_gram", _ridge_gram, _ridge_gram_sql(), ops="M7")
register("ridge_residuals", _ridge_residuals,
         " UNION ALL ".join([*(f"SELECT '{c}' AS feature, true AS solved" for c in NUMERIC_FEATURES),
                             *(f"SELECT DISTINCT '{c}=' || CAST({c} AS VARCHAR), true FROM train WHERE {c} IS NOT NULL"
                               for c in CATEGORICAL_FEATURES)]), ops="M7")
register("forecast_gbt_60_rounds", lambda w: w.gbt_forecasts, None, ops="M8 M9 M10")
register("model_metrics_ml", lambda w: w.model_metrics, None, ops="M11 M13 M14")
register("forecast_best_ml", lambda w: w.model_best, None, ops="M12")


def _driver_rows(w):
    """The driver's models over the holdout: what every model must agree with, whatever it predicts."""
    run = run_forecast(w)
    actual = F.sum("actual_weekly_sales")
    return run.forecasts.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("row_count"), actual.alias("actual_weekly_sales"),
        F.sum((F.col("forecast_weekly_sales") < 0).cast("int")).alias("negative_rows"),
        F.sum((F.abs(F.col("actual_weekly_sales") - F.col("forecast_weekly_sales") - F.col("forecast_error")) > 1e-6).cast("int"))
        .alias("error_mismatches"))


register("forecast_driver_60_rounds", _driver_rows,
         """SELECT m.model_name, count(*) AS row_count, sum(weekly_sales) AS actual_weekly_sales,
                   CAST(0 AS BIGINT) AS negative_rows, CAST(0 AS BIGINT) AS error_mismatches
            FROM holdout, (VALUES ('Seasonal Naive'), ('Rolling Mean'), ('Ridge Regression'), ('Gradient Boosted Trees')) m(model_name)
            GROUP BY m.model_name""", {"actual_weekly_sales": 6}, ops="M14")
# --- sources, sinks and the SQL catalog (A1, A2, A6, A7) ----------------------------
def _csv_roundtrip(w):
    path = f"{run_folder(w.spark, w.run_id)}/csv_roundtrip"
    out = w.sales.select(F.col("store").alias("Store"), F.col("dept").alias("Dept"),
                         F.col("date").alias("Date"), F.col("weekly_sales").alias("Weekly_Sales"),
                         F.col("is_holiday").alias("IsHoliday"))
    files.write_csv(out, path)
    return files.read_csv(w.spark, path, schemas.SALES)


register("src_csv_roundtrip", _csv_roundtrip,
         "SELECT store, dept, date, weekly_sales, is_holiday AS isholiday FROM sales", ops="A1 A2 B1")


def _csv_start(w):
    """The pipeline from CSV files: the derived inputs written out, and a second run that knows only the files."""
    folder = f"{run_folder(w.spark, w.run_id)}/csv_inputs"
    write_inputs(folder, w.sales, w.features, w.stores, w.test)
    # derived keys may be NULL (lines of unknown parts), which a strict file would not hold
    return Workspace(w.spark, w.sf_dir, w.fcfg, inputs=CsvInputs(w.spark, folder, keys_required=False))


register("csv_start_mart", lambda w: _csv_start(w).mart, "SELECT * FROM mart", ops="A1 A2")


def _built(w) -> str:
    """A schema of this run's own with the nine loaded tables and the four views."""
    at, database = run_folder(w.spark, w.run_id), f"shiftwise_{w.run_id}"
    load.write_load_files(w, f"{at}/files")
    load.build_schema(w.spark, f"{at}/files", database, f"{at}/tables")
    return database


def _reloaded_counts(w):
    """Row counts of the loaded tables after one was loaded again from a changed file, and once more from a bad one."""
    database, at = _built(w), run_folder(w.spark, w.run_id)
    sales = loader.TABLE_SPECS[0]
    header = w.sales.select(F.col("store").alias("Store"), F.col("dept").alias("Dept"), F.col("date").alias("Date"),
                            F.col("weekly_sales").alias("Weekly_Sales"), F.col("is_holiday").alias("IsHoliday"))
    files.write_csv(header.where("IsHoliday"), f"{at}/changed/train.csv")
    loader.load_csv(w.spark, sales, f"{at}/changed", database, f"{at}/tables")
    files.write_csv(header.withColumn("Weekly_Sales", F.lit("much")), f"{at}/bad/train.csv")
    try:
        loader.load_csv(w.spark, sales, f"{at}/bad", database, f"{at}/tables")
    except RejectedRows:
        pass  # the table stays as the changed file left it
    return validate.row_counts({s.name: w.spark.table(f"`{database}`.`{s.name}`") for s in loader.TABLE_SPECS})


register("load_tables_replace", _reloaded_counts,
         """SELECT 'raw_train_sales' AS table_name, count(*) AS row_count FROM sales WHERE is_holiday
            UNION ALL SELECT 'raw_features', count(*) FROM features
            UNION ALL SELECT 'raw_stores', count(*) FROM stores
            UNION ALL SELECT 'raw_test_sales', count(*) FROM test_keys
            UNION ALL SELECT 'analytics_forecast_output', count(*) FROM mart_forecast
            UNION ALL SELECT 'analytics_model_comparison', count(*) FROM metrics
            UNION ALL SELECT 'analytics_model_metrics', count(*) FROM metrics
            UNION ALL SELECT 'analytics_labor_standards', count(*) FROM standards
            UNION ALL SELECT 'analytics_simulated_schedule', count(*) FROM schedule""", ops="A5 A6 B2")
_VIEW_TOTALS = {"mart_workforce_dashboard": "site_readiness_score", "mart_store_week_summary": "required_labor_hours",
                "mart_forecast_accuracy_summary": "abs_forecast_error", "mart_top_at_risk_store_depts": "estimated_overtime_cost"}


def _views_by_name(w):
    """All four views, read by name in a second session."""
    database, other = _built(w), w.spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    return other.sql(" UNION ALL ".join(f"SELECT '{v}' AS view_name, COUNT(*) AS row_count, SUM({c}) AS total FROM `{database}`.`{v}`"
                                        for v, c in _VIEW_TOTALS.items()))


def _views_sql() -> str:
    summaries = {"mart_workforce_dashboard": "SELECT * FROM mart", "mart_store_week_summary": _REGISTRY["mart_store_week"].sql,
                 "mart_forecast_accuracy_summary": _REGISTRY["mart_accuracy_summary"].sql,
                 "mart_top_at_risk_store_depts": _AT_RISK_SQL}
    return " UNION ALL ".join(f"SELECT '{v}' AS view_name, count(*) AS row_count, sum({c}) AS total FROM ({summaries[v]}) x"
                              for v, c in _VIEW_TOTALS.items())


register("catalog_views", _views_by_name, _views_sql(), {"total": 6}, ops="A7 A9")


def _store_week_view(w):
    other = w.spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "UTC")
    return other.table(f"`{_built(w)}`.`mart_store_week_summary`")


register("view_store_week", _store_week_view, _REGISTRY["mart_store_week"].sql, _sw, ops="A7 K1")


def _files_by_model(w):
    """Both models' folders, after one model alone was written again."""
    path = f"{run_folder(w.spark, w.run_id)}/by_model"
    files.write_per_model(w.naive_forecasts, path)
    files.write_per_model(w.naive_forecasts.where("model_name = 'Rolling Mean' and is_holiday"), path)
    return w.spark.read.parquet(path).groupBy("model_slug", "model_name").agg(F.count(F.lit(1)).alias("row_count"))


register("forecast_files_by_model", _files_by_model,
         """SELECT lower(regexp_replace(model_name, '[ -]', '_', 'g')) AS model_slug, model_name, count(*) AS row_count
            FROM forecasts WHERE model_name <> 'Rolling Mean' OR is_holiday GROUP BY model_name""", ops="A3")


def _sql_trend(w):
    return sql_api.sql(w, sql_api.WEEKLY_TREND_SQL)


register("sql_weekly_trend", _sql_trend, grouped(("week_date",), summed(*questions.WEEKLY_SUMS)), _wt, ops="A6 A7 K8")
# --- the larger department grain (brand x type), for volume -------------------------
register("bt_feature_table", lambda w: w.feature_table, "SELECT * FROM feat", ops="M2 volume",
         grain="brand_type")
register("bt_mart_workforce", lambda w: w.mart, "SELECT * FROM mart", ops="R* volume",
         grain="brand_type")
register("bt_mart_store_week", lambda w: rollups.store_week_summary(w.mart),
         _REGISTRY["mart_store_week"].sql, _sw, ops="K1 volume", grain="brand_type")
register("bt_labor_standards", lambda w: w.labor_standards, "SELECT * FROM standards",
         ops="L1-L4 volume", grain="brand_type")
register("metrics_json", lambda w: evaluate.metrics_document(w.naive_metrics), None, ops="A4")


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def spark_callable(q: Query) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _round_spark(q.plan(Workspace(spark, sf_dir, REGISTERED, dept_grain=q.grain)), q.rounding)
    run.__name__ = q.name
    return run


def oracle_text(q: Query) -> str | None:
    if not q.sql:
        return None
    text = with_ctes(q.sql, q.grain)
    return _round_sql(text, q.rounding)
