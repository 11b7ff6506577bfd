"""Catalog part 4: changepoints, refit from sums and bands from rolling origins,
on series B (event type x day)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import backtest, changepoints, forecast, refit
from tidemark.plans.catalog_model import CONFIDENCE, MODEL_B_SQL, MODEL_COLS, SERIES_B_SQL, _rounded, train_b
from tidemark.session import materialize, scratch_path

# A solved system and running sums differ in the last bits between engines.
DIGITS = 4
VALUE_DIGITS = 4
# Days that series B is cut at: batches of a refit, and known from tried errors.
CUT = "2024-01-16"


def q_forecast_changepoints(spark, sf_dir):
    fc = changepoints.predict(changepoints.fit(train_b(spark, sf_dir)), 7, CONFIDENCE)
    return fc.withColumns({c: F.round(c, DIGITS) for c in ("yhat", "yhat_lower", "yhat_upper")})


def q_forecast_refit(spark, sf_dir):
    """The model of all days from a stored table of sums that got the days in
    two batches; equals the fit over everything."""
    train = materialize(train_b(spark, sf_dir))
    path = scratch_path(spark, "moments")
    cut = F.lit(CUT).cast("date")
    refit.refit(spark, path, train.where(F.col("ds") < cut), VALUE_DIGITS)
    return _rounded(refit.refit(spark, path, train.where(F.col("ds") >= cut), VALUE_DIGITS), MODEL_COLS)


def q_forecast_band(spark, sf_dir):
    train = materialize(train_b(spark, sf_dir))
    paths = materialize(backtest.paths(train))
    steps = backtest.widths(backtest.errors(paths, train), CONFIDENCE)
    plain = forecast.predict(refit.fit_from_moments(refit.moments(train, VALUE_DIGITS)), 7, CONFIDENCE)
    fc = backtest.banded(plain, paths, steps)
    return fc.withColumns({c: F.round(c, DIGITS) for c in ("yhat", "yhat_lower", "yhat_upper")})


def q_forecast_errors(spark, sf_dir):
    train = materialize(train_b(spark, sf_dir))
    found = backtest.errors(backtest.paths(train), train)
    return found.withColumns({"y": F.round("y", DIGITS), "yhat": F.round("yhat", DIGITS)})


_K = changepoints.CHANGEPOINTS
_SIZE = 2 + _K + 7
_NUM, _DEN = changepoints.RANGE
_C = f"({_NUM} * j / ({_DEN * _K})::DOUBLE)"
_Z = forecast.z_value(CONFIDENCE)
_DOW = "isodow({0})"

CHANGEPOINTS_SQL = f"""WITH RECURSIVE {SERIES_B_SQL},
pts AS (SELECT entity, ds, value::DOUBLE AS y FROM series_b WHERE value IS NOT NULL AND ds IS NOT NULL),
whole AS (SELECT entity, min(ds) AS first_ds, max(ds) AS last_ds, count(*) AS n, sum(y * y) AS syy,
    date_diff('day', min(ds), max(ds)) AS span FROM pts GROUP BY entity),
cells AS (SELECT entity, span, n, least({_K}, (x * {_DEN * _K}) // (span * {_NUM})) AS stretch, dow, count(*)::DOUBLE AS k,
    sum(x)::DOUBLE / span AS su, sum(x * x)::DOUBLE / (span * span) AS suu, sum(y) AS sy, sum(x * y) / span AS suy
    FROM (SELECT p.entity, span, n, isodow(ds) AS dow, date_diff('day', first_ds, ds) AS x, y
          FROM pts p JOIN whole w ON p.entity IS NOT DISTINCT FROM w.entity WHERE span > 0) GROUP BY entity, span, n, stretch, dow),
features AS (SELECT *, CASE WHEN f = 0 THEN 1.0 WHEN hinge THEN -c WHEN f - {1 + _K} = dow THEN 1.0 ELSE 0.0 END::DOUBLE AS a,
    CASE WHEN f = 1 OR hinge THEN 1.0 ELSE 0.0 END::DOUBLE AS b
    FROM (SELECT cells.*, f, f BETWEEN 2 AND {1 + _K} AND stretch >= f - 1 AS hinge, {_C.replace('j', '(f - 1)')} AS c
          FROM cells, range({_SIZE}) t(f))),
entries AS (SELECT p.entity, p.f, q.f AS g, sum(p.a * q.a * p.k + (p.a * q.b + p.b * q.a) * p.su + p.b * q.b * p.suu)
      + CASE WHEN p.f = q.f AND p.f >= 2 THEN {changepoints.PENALTY} * any_value(p.n) ELSE 0 END AS v
    FROM features p JOIN features q ON p.entity IS NOT DISTINCT FROM q.entity AND p.stretch = q.stretch AND p.dow = q.dow
    GROUP BY p.entity, p.f, q.f
    UNION ALL SELECT entity, f, {_SIZE}, sum(a * sy + b * suy) FROM features GROUP BY entity, f),
rows AS (SELECT entity, f, list(v ORDER BY g) AS r FROM entries GROUP BY entity, f),
solve AS (SELECT entity, 1 AS k, list(r ORDER BY f) AS m, list(r[{_SIZE + 1}] ORDER BY f) AS q FROM rows GROUP BY entity
    UNION ALL SELECT entity, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN list_transform(r, lambda v: v / r[k])
      ELSE list_transform(r, lambda v, j: v - r[k] / m[k][k] * m[k][j]) END), q FROM solve WHERE k <= {_SIZE}),
model AS (SELECT w.*, list_transform(m, lambda r: r[{_SIZE + 1}]) AS beta, q
    FROM whole w LEFT JOIN (SELECT * FROM solve WHERE k = {_SIZE + 1}) s ON w.entity IS NOT DISTINCT FROM s.entity),
sized AS (SELECT *, sqrt(greatest(syy - list_dot_product(beta, q)
      - {changepoints.PENALTY} * n * list_sum(list_transform(beta[3:], lambda v: v * v)), 0) / nullif(n - 1, 0)) AS sigma FROM model),
ahead AS (SELECT *, CAST(last_ds + h::INTEGER AS DATE) AS ds, date_diff('day', first_ds, last_ds) + h AS t
    FROM sized, range(1, 8) s(h)),
told AS (SELECT entity, h, ds, sigma, beta[1] + beta[2] * t / span + beta[{2 + _K} + isodow(ds)]
      + list_sum(list_transform(range(1, {_K + 1}), lambda j: beta[2 + j] * (t / span::DOUBLE - {_C}))) AS yhat FROM ahead)
SELECT entity, h::INTEGER AS h, ds, round(yhat, {DIGITS}) AS yhat, round(yhat - {_Z!r} * sigma, {DIGITS}) AS yhat_lower,
  round(yhat + {_Z!r} * sigma, {DIGITS}) AS yhat_upper FROM told"""

_DAYS = list(forecast.WEEKDAYS)
_BY_DAY = ", ".join(
    f"coalesce((sy_{d} - slope * sx_{d}) / nullif(n_{d}, 0), (sy - slope * sx) / n)" for d in _DAYS)
_USUAL = " + ".join(f"rn_{d} * level[{d}]" for d in _DAYS)

PATHS_SQL = f"""pts AS (SELECT entity, ds, value::DOUBLE AS y FROM series_b WHERE value IS NOT NULL AND ds IS NOT NULL),
days AS (SELECT *, date_diff('day', first, ds)::DOUBLE AS x, isodow(ds) AS dow
    FROM (SELECT entity, ds, y, min(ds) OVER (PARTITION BY entity) AS first, max(ds) OVER (PARTITION BY entity) AS last FROM pts)),
running AS (SELECT *, count(*) OVER past AS n, sum(x) OVER past AS sx, sum(x * x) OVER past AS sxx, sum(y) OVER past AS sy,
    sum(x * y) OVER past AS sxy, count(*) OVER late AS rn, sum(x) OVER late AS rsx, sum(y) OVER late AS rsy,
    {", ".join(f"count(*) FILTER (dow = {d}) OVER past AS n_{d}, coalesce(sum(x) FILTER (dow = {d}) OVER past, 0) AS sx_{d}, "
               f"coalesce(sum(y) FILTER (dow = {d}) OVER past, 0) AS sy_{d}, count(*) FILTER (dow = {d}) OVER late AS rn_{d}" for d in _DAYS)}
    FROM days WINDOW past AS (PARTITION BY entity ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      late AS (PARTITION BY entity ORDER BY ds ROWS BETWEEN {backtest.RECENT - 1} PRECEDING AND CURRENT ROW)),
sloped AS (SELECT *, (n * sxy - sx * sy) / nullif(n * sxx - sx * sx, 0) AS slope FROM running
    WHERE n >= {backtest.MIN_ROWS} AND ds > CAST(last - {backtest.ORIGIN_DAYS} AS DATE)),
levelled AS (SELECT *, [{_BY_DAY}] AS level FROM sloped WHERE slope IS NOT NULL),
started AS (SELECT *, (rsy - slope * rsx - ({_USUAL})) / rn AS start FROM levelled),
paths AS (SELECT entity, ds AS origin, last, h::INTEGER AS h, CAST(ds + h::INTEGER AS DATE) AS ds,
    level[isodow(CAST(ds + h::INTEGER AS DATE))] + slope * (x + h) + start AS yhat
    FROM started, range(1, {backtest.HORIZON + 1}) s(h)),
errors AS (SELECT p.entity, origin, h, p.ds, y, yhat FROM paths p JOIN pts ON p.entity IS NOT DISTINCT FROM pts.entity AND p.ds = pts.ds)"""

WIDTHS_SQL = f"""sizes AS (SELECT entity, h, count(*) AS m, list_sort(list(abs(y - yhat))) AS s FROM errors GROUP BY ALL),
widths AS (SELECT entity, h, max(s[least(m, ceil((m + 1) * {CONFIDENCE}))::INTEGER]) OVER (PARTITION BY entity ORDER BY h) AS width FROM sizes)"""


def _oracle() -> dict[str, str]:
    model_cols = ", ".join(f"ROUND({c}, 6) AS {c}" for c in MODEL_COLS)
    return {
        "forecast_changepoints": CHANGEPOINTS_SQL,
        "forecast_refit": f"WITH {MODEL_B_SQL}\nSELECT entity, first_ds, last_ds, n, {model_cols} FROM model",
        "forecast_errors": f"""WITH {SERIES_B_SQL},\n{PATHS_SQL}
SELECT entity, origin, h, ds, round(y, {DIGITS}) AS y, round(yhat, {DIGITS}) AS yhat FROM errors""",
        "forecast_band": f"""WITH {MODEL_B_SQL},
{PATHS_SQL.replace("pts AS (", "points AS (").replace(" pts", " points").replace("pts.", "points.")},
{WIDTHS_SQL},
told AS (SELECT f.entity, f.h, f.ds, coalesce(p.yhat, f.yhat) AS yhat, coalesce(w.width, {_Z!r} * f.sigma) AS width
    FROM fc f LEFT JOIN paths p ON f.entity IS NOT DISTINCT FROM p.entity AND p.origin = p.last AND p.h = f.h
      LEFT JOIN widths w ON f.entity IS NOT DISTINCT FROM w.entity AND w.h = f.h)
SELECT entity, h, ds, round(yhat, {DIGITS}) AS yhat, round(yhat - width, {DIGITS}) AS yhat_lower,
  round(yhat + width, {DIGITS}) AS yhat_upper FROM told""",
    }


QUERIES = {
    "forecast_changepoints": q_forecast_changepoints,
    "forecast_refit": q_forecast_refit,
    "forecast_errors": q_forecast_errors,
    "forecast_band": q_forecast_band,
}
