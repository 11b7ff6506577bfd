"""Catalog part 3: forecasting on series B (event type x day)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import forecast
from tidemark.plans.series_sources import event_type_day_series
from tidemark.session import materialize, scratch_path

CONFIDENCE = 0.8
DIGITS = 6
MODEL_COLS = ["slope", "intercept", "sigma"] + [f"effect_{d}" for d in forecast.WEEKDAYS]


def train_b(spark, sf_dir):
    return forecast.training_frame(event_type_day_series(spark, sf_dir), "entity", "ds", "value")


def _rounded(df, cols):
    return df.withColumns({c: F.round(c, DIGITS) for c in cols})


def q_forecast_fit(spark, sf_dir):
    return _rounded(forecast.fit(train_b(spark, sf_dir)), MODEL_COLS)


def q_forecast_7(spark, sf_dir):
    fc = forecast.predict(forecast.fit(train_b(spark, sf_dir)), 7, CONFIDENCE)
    return _rounded(fc, ["yhat", "yhat_lower", "yhat_upper"])


def q_history_plus_forecast(spark, sf_dir):
    # both branches read the training series: written once (small next to
    # events), so events is scanned once
    train = materialize(train_b(spark, sf_dir))
    fc = forecast.predict(forecast.fit(train), 7, CONFIDENCE)
    return _rounded(forecast.history_plus_forecast(train, fc), ["value", "yhat_lower", "yhat_upper"])


def q_model_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "model")
    forecast.save_model(forecast.fit(train_b(spark, sf_dir)), path)
    fc = forecast.predict(forecast.load_model(spark, path), 7, CONFIDENCE)
    return _rounded(fc, ["yhat", "yhat_lower", "yhat_upper"])


SERIES_B_SQL = """series_b AS (
  SELECT event_type AS entity, CAST(ts AS DATE) AS ds,
         CAST(SUM(CAST(value AS DECIMAL(20,4))) AS DECIMAL(20,4)) AS value
  FROM events GROUP BY 1, 2)"""

_EFFECTS = ",\n         ".join(
    f"MAX(CASE WHEN dow = {d} THEN effect END) AS effect_{d}" for d in forecast.WEEKDAYS
)
_EFFECT_OF_DS = "CASE isodow(ds) " + " ".join(
    f"WHEN {d} THEN effect_{d}" for d in forecast.WEEKDAYS) + " END"

MODEL_B_SQL = SERIES_B_SQL + f""",
pts AS (
  SELECT entity, ds, CAST(value AS DOUBLE) AS y,
         CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE) AS x
  FROM series_b WHERE value IS NOT NULL AND ds IS NOT NULL),
coef AS (
  SELECT entity, MIN(ds) AS first_ds, MAX(ds) AS last_ds, COUNT(*) AS n,
         REGR_SLOPE(y, x) AS slope, REGR_INTERCEPT(y, x) AS b0
  FROM pts GROUP BY entity),
res AS (
  SELECT p.entity, isodow(p.ds) AS dow, p.y - (c.b0 + c.slope * p.x) AS r
  FROM pts p JOIN coef c ON p.entity IS NOT DISTINCT FROM c.entity),
by_day AS (
  SELECT entity, dow, AVG(r) AS effect, COUNT(*) AS n_d,
         COALESCE(VAR_SAMP(r) * (COUNT(*) - 1), 0) AS ss
  FROM res GROUP BY entity, dow),
per_entity AS (
  SELECT entity, SQRT(SUM(ss) / NULLIF(SUM(n_d) - 1, 0)) AS sigma,
         {_EFFECTS}
  FROM by_day GROUP BY entity),
model AS (
  SELECT c.entity, first_ds, last_ds, n, slope,
         b0 + slope * date_diff('day', DATE '1970-01-01', first_ds) AS intercept,
         sigma, {", ".join(f"effect_{d}" for d in forecast.WEEKDAYS)}
  FROM coef c LEFT JOIN per_entity p ON c.entity IS NOT DISTINCT FROM p.entity),
fut AS (
  SELECT *, CAST(last_ds + CAST(h AS INTEGER) AS DATE) AS ds
  FROM (SELECT *, unnest(range(1, 8)) AS h FROM model)),
fc AS (
  SELECT entity, CAST(h AS INTEGER) AS h, ds,
         intercept + slope * CAST(date_diff('day', first_ds, ds) AS DOUBLE)
           + COALESCE({_EFFECT_OF_DS}, 0.0) AS yhat, sigma
  FROM fut)"""

Z = forecast.z_value(CONFIDENCE)
_R = DIGITS


def _oracle() -> dict[str, str]:
    fc_select = (f"SELECT entity, h, ds, ROUND(yhat, {_R}) AS yhat, "
                 f"ROUND(yhat - {Z!r} * sigma, {_R}) AS yhat_lower, "
                 f"ROUND(yhat + {Z!r} * sigma, {_R}) AS yhat_upper FROM fc")
    model_cols = ", ".join(f"ROUND({c}, {_R}) AS {c}" for c in MODEL_COLS)
    return {
        "forecast_fit": f"WITH {MODEL_B_SQL}\nSELECT entity, first_ds, last_ds, n, {model_cols} FROM model",
        "forecast_7": f"WITH {MODEL_B_SQL}\n{fc_select}",
        "model_table_roundtrip": f"WITH {MODEL_B_SQL}\n{fc_select}",
        "history_plus_forecast": f"""WITH {MODEL_B_SQL}
SELECT entity, ds, ROUND(CAST(value AS DOUBLE), {_R}) AS value, CAST(NULL AS DOUBLE) AS yhat_lower,
       CAST(NULL AS DOUBLE) AS yhat_upper, 'history' AS series FROM series_b
UNION ALL
SELECT entity, ds, ROUND(yhat, {_R}), ROUND(yhat - {Z!r} * sigma, {_R}),
       ROUND(yhat + {Z!r} * sigma, {_R}), 'forecast' FROM fc""",
    }


QUERIES = {
    "forecast_fit": q_forecast_fit,
    "forecast_7": q_forecast_7,
    "history_plus_forecast": q_history_plus_forecast,
    "model_table_roundtrip": q_model_table_roundtrip,
}
