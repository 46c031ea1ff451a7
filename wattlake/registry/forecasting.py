"""Hourly series, features, metrics and the day-ahead forecast."""

from __future__ import annotations

from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from wattlake import fixtures as fx
from wattlake.operators import forecast, keyed, profiles, series
from wattlake.plans.demand_response import demand_response
from wattlake.registry.base import mean, register, rnd, total
from wattlake.session import scratch_dir

KEYS = ["building_id"]
CAMPUS_HOURS = f"""
    SELECT date_trunc('hour', timestamp) AS ds, {rnd(mean('load'), 2)} AS total_power_kw,
           {rnd(mean('volts', 8), 2)} AS avg_voltage_v, {rnd(mean('pf', 8), 3)} AS avg_power_factor
    FROM (SELECT timestamp, {total('power_kw')} AS load, {mean('voltage_v')} AS volts, {mean('power_factor')} AS pf
          FROM telemetry GROUP BY timestamp) GROUP BY 1"""
LAGGED = """
    SELECT *, lag(total_power_kw, 1) OVER (PARTITION BY building_id ORDER BY ds) AS lag_1,
           lag(total_power_kw, 24) OVER (PARTITION BY building_id ORDER BY ds) AS lag_24 FROM building_hours"""
FILLED = f"""
    SELECT * EXCLUDE (hour_mean) REPLACE (COALESCE(lag_1, hour_mean) AS lag_1, COALESCE(lag_24, hour_mean) AS lag_24)
    FROM (SELECT *, CAST(SUM(CAST(total_power_kw AS DECIMAL(18,4))) OVER w AS DOUBLE)
                    / NULLIF(COUNT(total_power_kw) OVER w, 0) AS hour_mean
          FROM ({LAGGED}) WINDOW w AS (PARTITION BY building_id, extract(hour FROM ds)))"""
SPLIT = """
    SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY ds)
              <= floor(COUNT(*) OVER (PARTITION BY building_id) * 0.8::DOUBLE) AS is_train FROM building_hours"""
CAMPUS_LAG = f"(SELECT *, lag(total_power_kw, 24) OVER (ORDER BY ds) AS prediction FROM ({CAMPUS_HOURS}))"


def campus(spark, sf_dir):
    return series.campus_series(profiles.hourly_load(fx.readings(spark, sf_dir)))


def per_building(spark, sf_dir):
    return profiles.hourly_load(fx.readings(spark, sf_dir), KEYS)


@register("hourly_load", CAMPUS_HOURS)
def _(spark, sf_dir):
    return campus(spark, sf_dir).drop("series")


register("hourly_load_per_building", "SELECT * FROM building_hours")(per_building)


@register("add_lags", LAGGED)
def _(spark, sf_dir):
    return series.add_lags(per_building(spark, sf_dir), KEYS)


@register("backfill_lags", FILLED)
def _(spark, sf_dir):
    return series.backfill_lags(series.add_lags(per_building(spark, sf_dir), KEYS), KEYS)


@register("time_features", f"""
    SELECT building_id, ds, total_power_kw, lag_1, lag_24, extract(hour FROM ds)::BIGINT AS hour,
           (isodow(ds) - 1)::BIGINT AS day_of_week, (isodow(ds) >= 6)::BIGINT AS is_weekend,
           ROUND(sin(2 * pi() * extract(hour FROM ds) / 24), 9) + 0.0::DOUBLE AS sin_hour,
           ROUND(cos(2 * pi() * extract(hour FROM ds) / 24), 9) + 0.0::DOUBLE AS cos_hour,
           ROUND(sin(2 * pi() * (isodow(ds) - 1) / 7), 9) + 0.0::DOUBLE AS sin_day,
           ROUND(cos(2 * pi() * (isodow(ds) - 1) / 7), 9) + 0.0::DOUBLE AS cos_day
    FROM ({FILLED})""")
def _(spark, sf_dir):
    rows = series.time_features(per_building(spark, sf_dir), KEYS)
    return rows.select(
        *KEYS, "ds", "total_power_kw", "lag_1", "lag_24",
        *[F.col(name).cast("bigint").alias(name) for name in ("hour", "day_of_week", "is_weekend")],
        *[(F.round(name, 9) + F.lit(0.0)).alias(name) for name in ("sin_hour", "cos_hour", "sin_day", "cos_day")])


@register("chronological_split", SPLIT)
def _(spark, sf_dir):
    return series.chronological_split(per_building(spark, sf_dir), keys=KEYS)


@register("last_day_of_series", """
    SELECT * FROM building_hours QUALIFY row_number() OVER (PARTITION BY building_id ORDER BY ds DESC) <= 24""")
def _(spark, sf_dir):
    return keyed.last_n(per_building(spark, sf_dir), 24, KEYS)


def naive(spark, sf_dir):
    """Yesterday's load at the same position as the prediction."""
    return series.add_lags(campus(spark, sf_dir)).withColumnRenamed("lag_24", "prediction")


@register("regression_metrics", f"""
    SELECT {rnd('AVG(abs(e))', 2)} AS MAE, {rnd('sqrt(AVG(e * e))', 2)} AS RMSE,
           {rnd('AVG(abs(e) / GREATEST(abs(total_power_kw), 2.220446049250313e-16)) * 100', 2)} AS MAPE,
           COUNT(*) AS test_samples
    FROM (SELECT *, total_power_kw - prediction AS e FROM {CAMPUS_LAG} WHERE prediction IS NOT NULL)""")
def _(spark, sf_dir):
    return series.regression_metrics(naive(spark, sf_dir).where("prediction IS NOT NULL"))


@register("confidence_band", f"""
    SELECT ds, step, predicted_load_kw,
           GREATEST(0.0::DOUBLE, {rnd('predicted_load_kw - margin', 2)}) AS lower_ci_95,
           {rnd('predicted_load_kw + margin', 2)} AS upper_ci_95
    FROM (SELECT *, {rnd('1.96::DOUBLE * 45.0::DOUBLE * (1.0::DOUBLE + step * 0.02::DOUBLE)', 2)} AS margin
          FROM (SELECT ds, extract(hour FROM ds)::BIGINT AS step, prediction AS predicted_load_kw
                FROM {CAMPUS_LAG} WHERE prediction IS NOT NULL))""")
def _(spark, sf_dir):
    rows = naive(spark, sf_dir).where("prediction IS NOT NULL").select(
        "ds", F.hour("ds").cast("bigint").alias("step"), F.col("prediction").alias("predicted_load_kw"))
    return forecast.confidence_band(rows, 45.0)


@register("forecast_24h")
def _(spark, sf_dir):
    """The better of the two models, trained on the campus series, applied to it."""
    history = campus(spark, sf_dir)
    chosen = forecast.select_model(history)
    return forecast.forecast_24h(chosen.model, history, rmse=chosen.metrics["RMSE"])


@register("forecast_24h_per_building")
def _(spark, sf_dir):
    """One ridge model over all building series, tested on their last fifth and applied to each of them."""
    rows = per_building(spark, sf_dir).withColumnRenamed("building_id", "series")
    known = series.time_features(rows.where(F.col(series.LOAD).isNotNull())).dropna("any", subset=list(series.FEATURES))
    split = series.chronological_split(known, forecast.TRAIN_RATIO, keys=["series"])
    model = forecast.fit_ridge(split.where("is_train"))
    errors = series.regression_metrics(model.transform(split.where("NOT is_train")), keys=["series"])
    return forecast.forecast_24h(model, rows, floor_kw=0.0, rmse_of=errors)


GIVEN = "0.5D * lag_1 + 0.25D * lag_24 + 0.125D * hour + 1D"        # a model whose coefficients are known


RECURSION = f"""
    SELECT building_id, forecast_time, hour_of_day, predicted_load_kw,
           GREATEST(0.0::DOUBLE, {rnd('predicted_load_kw - margin', 2)}) AS lower_ci_95,
           {rnd('predicted_load_kw + margin', 2)} AS upper_ci_95
    FROM (SELECT *, {rnd('1.96::DOUBLE * 45.0::DOUBLE * (1.0::DOUBLE + (step - 1) * 0.02::DOUBLE)', 2)} AS margin
          FROM (WITH RECURSIVE ends AS (
                    SELECT building_id, MAX(ds) AS last_ds FROM building_hours GROUP BY building_id ),
                tails AS (
                    SELECT building_id, list(total_power_kw ORDER BY ds) AS loads
                    FROM (SELECT * FROM building_hours WHERE total_power_kw IS NOT NULL
                          QUALIFY row_number() OVER (PARTITION BY building_id ORDER BY ds DESC) <= 24)
                    GROUP BY building_id ),
                run AS (
                    SELECT building_id, 0 AS step, last_ds AS forecast_time, 0::BIGINT AS hour_of_day,
                           COALESCE(loads, []::DOUBLE[]) AS loads
                    FROM ends LEFT JOIN tails USING (building_id)
                    UNION ALL
                    SELECT building_id, step + 1, due, extract(hour FROM due)::BIGINT,
                           list_append(loads, GREATEST(0.0::DOUBLE, {rnd(
                               '0.5::DOUBLE * newest + 0.25::DOUBLE * COALESCE(loads[-24], newest)'
                               ' + 0.125::DOUBLE * extract(hour FROM due) + 1.0::DOUBLE', 2)}))
                    FROM (SELECT *, forecast_time + INTERVAL '1' HOUR AS due, COALESCE(loads[-1], 800.0::DOUBLE) AS newest
                          FROM run WHERE step < 24) )
                SELECT building_id, step, forecast_time, hour_of_day, loads[-1] AS predicted_load_kw
                FROM run WHERE step > 0))"""


@register("forecast_recursion", RECURSION)
def given_forecast(spark, sf_dir):
    """The recursion with given coefficients, each building on its own history."""
    model = SQLTransformer(statement=f"SELECT *, {GIVEN} AS prediction FROM __THIS__")
    found = forecast.forecast_24h(model, per_building(spark, sf_dir), KEYS, floor_kw=0.0)
    return found.withColumn("hour_of_day", F.col("hour_of_day").cast("bigint"))


# --- models per series -----------------------------------------------------

PAIR = ("lag_1", "lag_24")
KNOWN = f"(SELECT * FROM ({LAGGED}) WHERE lag_1 IS NOT NULL AND lag_24 IS NOT NULL AND total_power_kw IS NOT NULL)"


def _ridge_sql(rows: str) -> str:
    """Ridge regression on two features in closed form: the centred normal equations by Cramer's rule."""
    return f"""
    SELECT building_id, n, w_1, w_24, my - w_1 * m1 - w_24 * m2 AS intercept
    FROM (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS w_1,
                 (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS w_24
          FROM (SELECT building_id, COUNT(*) AS n, AVG(lag_1) AS m1, AVG(lag_24) AS m2, AVG(total_power_kw) AS my,
                       COUNT(*) * var_pop(lag_1) + 1 AS s11, COUNT(*) * var_pop(lag_24) + 1 AS s22,
                       COUNT(*) * covar_pop(lag_1, lag_24) AS s12, COUNT(*) * covar_pop(lag_1, total_power_kw) AS s1y,
                       COUNT(*) * covar_pop(lag_24, total_power_kw) AS s2y
                FROM {rows} GROUP BY building_id))"""


def known_rows(spark, sf_dir):
    rows = series.add_lags(per_building(spark, sf_dir), KEYS)
    return rows.dropna("any", subset=[*PAIR, series.LOAD])


@register("ridge_per_series", f"""
    SELECT building_id, n, ROUND(w_1, 6) AS w_1, ROUND(w_24, 6) AS w_24, ROUND(intercept, 5) AS intercept
    FROM ({_ridge_sql(KNOWN)})""")
def _(spark, sf_dir):
    """A ridge model of each building's load, all fitted in one pass."""
    models = forecast.fit_ridge_per_series(known_rows(spark, sf_dir), KEYS, features=PAIR)
    weight = F.col("coefficients")
    return models.select("building_id", "n", F.round(weight[0], 6).alias("w_1"), F.round(weight[1], 6).alias("w_24"),
                         F.round("intercept", 5).alias("intercept"))


PARTS = f"""(SELECT *, row_number() OVER (PARTITION BY building_id ORDER BY ds)
                    <= floor(COUNT(*) OVER (PARTITION BY building_id) * 0.8::DOUBLE) AS is_train FROM {KNOWN})"""
TESTED = f"""
    SELECT building_id, 'ridge' AS model, 0 AS place, total_power_kw AS y, intercept + w_1 * lag_1 + w_24 * lag_24 AS p
    FROM {PARTS} JOIN ({_ridge_sql(f"(SELECT * FROM {PARTS} WHERE is_train)")}) USING (building_id) WHERE NOT is_train
    UNION ALL SELECT building_id, 'naive', 1, total_power_kw, lag_24 FROM {PARTS} WHERE NOT is_train"""


@register("model_choice_per_series", f"""
    SELECT building_id, model, MAE, RMSE, MAPE, test_samples,
           row_number() OVER (PARTITION BY building_id ORDER BY RMSE NULLS LAST, place) = 1 AS chosen
    FROM (SELECT building_id, model, place, {rnd('AVG(abs(y - p))', 2)} AS MAE, {rnd('sqrt(AVG((y - p) * (y - p)))', 2)} AS RMSE,
                 {rnd('AVG(abs(y - p) / GREATEST(abs(y), 2.220446049250313e-16)) * 100', 2)} AS MAPE, COUNT(*) AS test_samples
          FROM ({TESTED}) GROUP BY ALL)""")
def _(spark, sf_dir):
    """Ridge against yesterday's load, each building judged on the last fifth of its hours."""
    rows = series.chronological_split(known_rows(spark, sf_dir), keys=KEYS)
    models = forecast.fit_ridge_per_series(rows.where("is_train"), KEYS, features=PAIR)
    test = rows.where("NOT is_train")
    return forecast.compare_per_series({
        "ridge": forecast.predict_ridge(test, models, KEYS, PAIR),
        "naive": test.withColumn("prediction", F.col("lag_24"))}, KEYS)


@register("model_selection", f"""
    SELECT model, COUNT(*) - floor(COUNT(*) * 0.8::DOUBLE)::BIGINT AS test_samples, TRUE AS better_than_naive, TRUE AS as_chosen
    FROM ({CAMPUS_HOURS}) CROSS JOIN (SELECT unnest(['RandomForestRegressor', 'RidgeRegressor']) AS model)
    WHERE total_power_kw IS NOT NULL GROUP BY model""")
def _(spark, sf_dir):
    """Both models of the campus on the last fifth of its hours: each has a lower error than yesterday's load, and the
    one with the lower error is the one that is kept."""
    rows = campus(spark, sf_dir)
    known = series.time_features(rows.where(F.col(series.LOAD).isNotNull()))
    split = series.chronological_split(known.dropna("any", subset=list(series.FEATURES)), forecast.TRAIN_RATIO)
    baseline = series.regression_metrics(split.where("NOT is_train").withColumn("prediction", F.col("lag_24"))).first()
    chosen = forecast.select_model(rows)
    lowest = min(found["RMSE"] for found in chosen.compared.values())
    return spark.createDataFrame(
        [(name, chosen.test_samples, found["RMSE"] < baseline["RMSE"], (found["RMSE"] == lowest) or name != chosen.name)
         for name, found in chosen.compared.items()], "model string, test_samples bigint, better_than_naive boolean, as_chosen boolean")


# --- forecast to audit trail -----------------------------------------------

FLOW_LIMIT = 120.0


@register("demand_response_flow", f"""
    SELECT building_id, violation_hours_count, peak_forecast_kw, max_overload_kw, armed, lowered_peak_kw,
           CASE WHEN violation_hours_count > 0 THEN printf('Peak Demand Breach (+%.1f kW)', max_overload_kw) END AS title
    FROM (SELECT building_id, COUNT(*) FILTER (WHERE load > {FLOW_LIMIT}) AS violation_hours_count, MAX(load) AS peak_forecast_kw,
                 MAX(over) AS max_overload_kw, CASE WHEN MAX(over) > 135 THEN 3 WHEN MAX(over) > 45 THEN 2 WHEN MAX(over) > 0 THEN 1
                                                   ELSE 0 END::BIGINT AS armed,
                 MAX(CASE WHEN load > {FLOW_LIMIT} THEN {rnd(f'GREATEST({FLOW_LIMIT}::DOUBLE, load - LEAST(over, 295.0::DOUBLE))', 2)}
                          ELSE load END) AS lowered_peak_kw
          FROM (SELECT building_id, predicted_load_kw AS load,
                       {rnd(f'GREATEST(0.0::DOUBLE, MAX(predicted_load_kw) OVER (PARTITION BY building_id) - {FLOW_LIMIT})', 2)} AS over
                FROM ({RECURSION})) GROUP BY building_id)""")
def _(spark, sf_dir):
    """Each building's day ahead, planned for, with its card from the audit trail."""
    made = demand_response(given_forecast(spark, sf_dir), scratch_dir(spark, "demand-response"), KEYS, FLOW_LIMIT)
    armed = made["actions"].groupBy(*KEYS).agg(F.count_if(F.col("status") == "ARMED").alias("armed"))
    lowered = made["curve"].groupBy(*KEYS).agg(F.max("dispatched_load_kw").alias("lowered_peak_kw"))
    sent = made["audit"].join(made["cards"].select(*KEYS, "title", "payload"), ["title", "payload"]).select(*KEYS, "title")
    return made["plans"].join(armed, KEYS, "left").join(lowered, KEYS, "left").join(sent, KEYS, "left").select(
        *KEYS, "violation_hours_count", "peak_forecast_kw", "max_overload_kw",
        F.coalesce("armed", F.lit(0)).alias("armed"), "lowered_peak_kw", "title")
