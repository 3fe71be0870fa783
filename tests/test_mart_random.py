"""The mart on random rows (with NULLs everywhere) against a plain-Python
reading of the view's SQL rules, row by row."""

import datetime as dt
import math
import random

import pytest

from shiftwise.operators.mart import workforce_mart

D = dt.date(2001, 1, 1)


def _div(a, b):
    return None if a is None or b is None or b == 0 else a / b


def _least_c(x, cap):
    return min(x, cap)


def _expected(f, std, sch):
    target = std.get(f["dept"])
    s = sch.get((f["store"], f["dept"]))
    hours = s["scheduled_labor_hours"] if s else None
    callout = s["callout_rate"] if s else None
    flex = s["flex_pool_hours"] if s else None
    rate = s["avg_hourly_rate"] if s else None
    per = s["avg_weekly_hours_per_associate"] if s else None
    req = _div(f["forecast"], target)
    avail = None if hours is None or callout is None else hours * (1 - callout)
    gap = None if req is None or avail is None else req - avail
    ot_raw = None if gap is None or flex is None else gap - flex
    ot = None if ot_raw is None else max(ot_raw, 0.0)
    cost = None if ot is None or rate is None else ot * rate * 1.5
    cov = _div(avail, req)
    prod = _div(f["actual"], avail)
    prod_t = _div(prod, target)
    abs_err = None if f["actual"] is None or f["forecast"] is None else abs(f["actual"] - f["forecast"])
    share = _div(abs_err, f["actual"])
    cov_s = _least_c(cov if cov is not None else 0.0, 1.1) / 1.1 * 40.0
    acc_s = max(0.0, 1.0 - min(share if share is not None else 1.0, 1.0)) * 25.0
    prod_s = _least_c(prod_t if prod_t is not None else 0.0, 1.1) / 1.1 * 25.0
    hol_s = 5 if f["holiday"] else 10
    raw = min(100.0, max(0.0, cov_s + acc_s + prod_s + hol_s))
    status = "Ready" if raw >= 85 else "Watch" if raw >= 70 else "At Risk"
    if gap is not None and gap >= 24:
        rec = "Add associates or approve overtime"
    elif gap is not None and gap >= 8:
        rec = "Use flex pool / monitor schedule"
    elif gap is not None and gap <= -24:
        rec = "Potential overstaffing - review schedule"
    else:
        rec = "Staffing balanced"
    return {"required_labor_hours": req, "available_labor_hours": avail, "labor_gap_hours": gap,
            "overtime_risk_hours": ot, "estimated_overtime_cost": cost, "coverage_pct": cov,
            "productivity_to_target_pct": prod_t, "site_readiness_status": status,
            "overtime_risk_flag": "At Risk" if ot is not None and ot > 0 else "Covered",
            "recommendation": rec, "raw": raw}


def _maybe(rng, v, p=0.15):
    return None if rng.random() < p else v


def test_random_rows_follow_the_rules(spark):
    rng = random.Random(5)
    fore, std, sch = [], {}, {}
    for dept in range(1, 6):
        if rng.random() < 0.8:
            std[dept] = rng.choice([0.0, 700.0, 950.0, 1250.0, None])
    for store in range(1, 41):
        dept = rng.randint(1, 6)
        actual = _maybe(rng, rng.choice([0.0, rng.uniform(0, 60000)]))
        forecast = _maybe(rng, rng.choice([0.0, rng.uniform(0, 60000)]))
        fore.append({"store": store, "dept": dept, "actual": actual, "forecast": forecast,
                     "holiday": rng.random() < 0.3})
        if rng.random() < 0.85:
            sch[(store, dept)] = {
                "scheduled_labor_hours": _maybe(rng, rng.uniform(0, 80)),
                "callout_rate": _maybe(rng, rng.choice([0.045, 0.075])),
                "flex_pool_hours": _maybe(rng, rng.uniform(0, 4)),
                "avg_hourly_rate": _maybe(rng, rng.choice([16.75, 17.5, 18.5])),
                "avg_weekly_hours_per_associate": rng.choice([32, 0, None]),
            }
    fdf = spark.createDataFrame(
        [(f["store"], f["dept"], D, "A", 1, f["holiday"], f["actual"], f["forecast"],
          None if f["actual"] is None or f["forecast"] is None else f["actual"] - f["forecast"],
          None if f["actual"] is None or f["forecast"] is None else abs(f["actual"] - f["forecast"]),
          None, 1.0, 1.0, 1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0) for f in fore],
        "store int, dept int, date date, store_type string, store_size int, is_holiday boolean, "
        "actual_weekly_sales double, forecast_weekly_sales double, forecast_error double, "
        "abs_forecast_error double, forecast_variance_pct double, temperature double, fuel_price double, "
        "cpi double, unemployment double, markdown1 double, markdown2 double, markdown3 double, "
        "markdown4 double, markdown5 double")
    sdf = spark.createDataFrame([(d, "T", t) for d, t in std.items()],
                                "dept int, volume_tier string, target_sales_per_labor_hour double")
    hdf = spark.createDataFrame(
        [(k[0], k[1], D, v["scheduled_labor_hours"], 1, v["callout_rate"], v["flex_pool_hours"],
          v["avg_hourly_rate"], v["avg_weekly_hours_per_associate"]) for k, v in sch.items()],
        "store int, dept int, date date, scheduled_labor_hours double, scheduled_associates bigint, "
        "callout_rate double, flex_pool_hours double, avg_hourly_rate double, "
        "avg_weekly_hours_per_associate int")
    got = {r.store: r for r in workforce_mart(fdf, sdf, hdf).collect()}
    assert len(got) == len(fore)
    for f in fore:
        exp, r = _expected(f, std, sch), got[f["store"]]
        for c in ("required_labor_hours", "available_labor_hours", "labor_gap_hours",
                  "overtime_risk_hours", "estimated_overtime_cost", "coverage_pct",
                  "productivity_to_target_pct"):
            e, g = exp[c], r[c]
            assert (e is None) == (g is None), (f, c, e, g)
            if e is not None:
                assert g == pytest.approx(e, rel=1e-12, abs=1e-12), (f, c)
        for c in ("site_readiness_status", "overtime_risk_flag", "recommendation"):
            assert r[c] == exp[c], (f, c, r[c], exp[c])
        assert r.site_readiness_score == pytest.approx(round(exp["raw"] + 1e-12, 1), abs=0.051)
