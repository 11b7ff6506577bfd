"""Changepoints, refit from sums, and bands from rolling origins, each against a
direct numpy version."""

import datetime as dt

import numpy as np
import pytest

from tidemark.operators import backtest, changepoints, forecast, refit

D0 = dt.date(2024, 1, 3)
SCHEMA = "entity string, ds date, y double"


def days(n, step=1):
    return [D0 + dt.timedelta(days=i * step) for i in range(n)]


def noisy(seed, n=90, entities=("a", "b", None)):
    rng = np.random.default_rng(seed)
    rows = []
    for e in entities:
        walk = np.cumsum(rng.normal(0, 1.5, n)) + 50
        for i, d in enumerate(days(n)):
            if rng.random() < 0.9:
                rows.append((e, d, round(float(walk[i] + (7 if d.isoweekday() == 6 else 0)), 4)))
    return rows


def odd(rows):
    """Rows that count for nothing, several rows of a day, short histories."""
    return [*rows, ("a", None, 1.0), ("b", D0, None), ("a", D0, 3.0), ("a", D0, 3.0), ("one", D0, 2.5),
            ("day", D0, 1.0), ("day", D0, 2.0), ("two", D0, 1.0), ("two", D0 + dt.timedelta(days=30), 4.0)]


def series(rows):
    out = {}
    for e, d, y in rows:
        if d is not None and y is not None:
            out.setdefault(e, []).append((d, y))
    return out


# ------------------------------------------------------------------ changepoints
def brute_fit(points, count=changepoints.CHANGEPOINTS, penalty=changepoints.PENALTY):
    first, last = min(d for d, _ in points), max(d for d, _ in points)
    span = (last - first).days
    u = np.array([(d - first).days / span for d, _ in points])
    y = np.array([v for _, v in points])
    dow = np.array([d.isoweekday() for d, _ in points])
    c = np.array(changepoints.places(count))
    x = np.column_stack([np.ones_like(u), u, np.maximum(u[:, None] - c, 0), dow[:, None] == np.arange(1, 8)])
    ridge = np.diag([0.0, 0.0] + [penalty * len(u)] * (count + 7))
    beta = np.linalg.solve(x.T @ x + ridge, x.T @ y)
    return first, last, span, beta, np.sqrt(((y - x @ beta) ** 2).sum() / (len(u) - 1)), c


def test_changepoints_match_a_direct_solution(spark):
    rows = odd(noisy(3))
    train = spark.createDataFrame(rows, SCHEMA).repartition(5)
    models = {r.entity: r for r in changepoints.fit(train).collect()}
    told = changepoints.predict(changepoints.fit(train), 9, 0.9).collect()
    z = forecast.z_value(0.9)
    assert set(models) == set(series(rows))
    for e, points in series(rows).items():
        m, ahead = models[e], {r.h: r for r in told if r.entity == e}
        assert len(ahead) == 9 and m.n == len(points)
        if m.span == 0:
            assert m.slope is None and m.changes is None and all(r.yhat is None for r in ahead.values())
            continue
        first, last, span, beta, sigma, c = brute_fit(points)
        assert m.intercept == pytest.approx(beta[0], rel=1e-7) and m.slope == pytest.approx(beta[1] / span, rel=1e-6)
        assert m.changes == pytest.approx(beta[2:12] / span, rel=1e-6, abs=1e-9)
        assert m.effects == pytest.approx(beta[12:], rel=1e-6, abs=1e-9)
        assert m.sigma == pytest.approx(sigma, rel=1e-5, abs=1e-6)
        for h, r in ahead.items():
            d = last + dt.timedelta(days=h)
            u = (d - first).days / span
            want = beta[0] + beta[1] * u + (beta[2:12] * np.maximum(u - c, 0)).sum() + beta[11 + d.isoweekday()]
            assert r.ds == d and r.yhat == pytest.approx(want, rel=1e-7)
            assert r.yhat_upper - r.yhat == pytest.approx(z * sigma, rel=1e-5, abs=1e-6)


def test_a_broken_line_is_recovered(spark):
    """Slope 2 for 120 days, then -1: one straight line misses it by far."""
    value = lambda i: 2.0 * i if i < 120 else 240.0 - (i - 120)
    train = spark.createDataFrame([("x", d, value(i)) for i, d in enumerate(days(240))], SCHEMA)
    bent = changepoints.predict(changepoints.fit(train, penalty=1e-6), 7).orderBy("h").collect()
    straight = forecast.predict(forecast.fit(train), 7).orderBy("h").collect()
    want = [value(240 + i) for i in range(7)]
    assert [r.yhat for r in bent] == pytest.approx(want, abs=3.0)
    assert min(abs(r.yhat - w) for r, w in zip(straight, want)) > 40
    model = changepoints.fit(train, penalty=1e-6).first()
    assert model.slope == pytest.approx(2.0, abs=0.1) and model.slope + sum(model.changes) == pytest.approx(-1.0, abs=0.1)
    # the bend lies between the places at 40 and 56 per cent of the history
    assert int(np.argmin(model.changes)) in (5, 6)


def test_changepoints_of_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert changepoints.fit(none).collect() == [] and changepoints.predict(changepoints.fit(none)).collect() == []


# ------------------------------------------------------------------ refit
def test_refit_equals_fit(spark):
    rows = odd(noisy(5))
    train = spark.createDataFrame(rows, SCHEMA)
    want = {r.entity: r for r in forecast.fit(train).collect()}
    for digits in (None, 4):
        got = {r.entity: r for r in refit.fit_from_moments(refit.moments(train, digits)).collect()}
        assert set(got) == set(want)
        for e, w in want.items():
            for c in w.__fields__[1:]:
                g = getattr(got[e], c)
                if w.slope is None and (c.startswith("effect") or c in ("intercept", "sigma")):
                    assert g is None
                elif isinstance(g, float):
                    assert g == pytest.approx(getattr(w, c), rel=1e-7, abs=1e-7), (e, c)
                else:
                    assert g == getattr(w, c), (e, c)


def test_merge_is_exact_whatever_the_batches(spark):
    rows = odd(noisy(8))
    train = spark.createDataFrame(rows, SCHEMA)
    whole = sorted(map(tuple, refit.moments(train, 4).collect()), key=repr)
    for size in (1, 2, 5):
        parts = [refit.moments(spark.createDataFrame(rows[i::size], SCHEMA), 4) for i in range(size)]
        assert sorted(map(tuple, refit.merge(*parts).select(*refit.moments(train, 4).columns).collect()), key=repr) == whole


def test_refit_table_follows_batches(spark, tmp_dir):
    rows = noisy(9)
    cut = [D0, D0 + dt.timedelta(days=30), D0 + dt.timedelta(days=31), dt.date(2030, 1, 1)]
    for a, b in zip(cut, cut[1:]):
        batch = [r for r in rows if a <= r[1] < b]
        got = refit.refit(spark, f"{tmp_dir}/moments", spark.createDataFrame(batch, SCHEMA), 4)
        want = refit.fit_from_moments(refit.moments(spark.createDataFrame([r for r in rows if r[1] < b], SCHEMA), 4))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert refit.fit_from_moments(refit.moments(spark.createDataFrame([], SCHEMA))).collect() == []


# ------------------------------------------------------------------ bands
def brute_errors(points, horizon=7, min_rows=14, recent=7):
    out = {}
    first = min(d for d, _ in points)
    for origin in sorted({d for d, _ in points}):
        known = [(d, y) for d, y in points if d <= origin]
        if len(known) < min_rows or len({d for d, _ in known}) < 2:
            continue
        x = np.array([(d - first).days for d, _ in known], float)
        y = np.array([v for _, v in known])
        slope, level = np.polyfit(x, y, 1)
        left = y - slope * x
        dow = np.array([d.isoweekday() for d, _ in known])
        usual = {k: left[dow == k].mean() if (dow == k).any() else left.mean() for k in range(1, 8)}
        late = sorted({d for d, _ in known})[-recent:]
        start = np.mean([v - usual[k] for v, k, (d, _) in zip(left, dow, known) if d in late])
        for h in range(1, horizon + 1):
            at = origin + dt.timedelta(days=h)
            yhat = usual[at.isoweekday()] + slope * (at - first).days + start
            out.update({(origin, h, i): (v, yhat) for i, (d, v) in enumerate(points) if d == at})
    return out


def test_errors_match_a_fit_at_every_origin(spark):
    rows = odd(noisy(11, 40))
    train = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = backtest.errors(backtest.paths(train), train).collect()
    for e, points in series(rows).items():
        want = sorted((o, h, y, p) for (o, h, _), (y, p) in brute_errors(points).items())
        mine = sorted((r.origin, r.h, r.y, r.yhat) for r in got if r.entity == e)
        assert [m[:3] for m in mine] == [w[:3] for w in want]
        assert [m[3] for m in mine] == pytest.approx([w[3] for w in want], rel=1e-6)


def test_width_is_the_conformal_quantile_and_never_shrinks(spark):
    rows = [("a", D0, h, D0, float(e), 0.0) for h, sizes in ((1, range(1, 10)), (2, [-3.0]), (3, range(0, 200, 10))) for e in sizes]
    found = spark.createDataFrame(rows, "entity string, origin date, h int, ds date, y double, yhat double")
    got = {r.h: (r.errors, r.width) for r in backtest.widths(found, 0.8).collect()}
    assert got == {1: (9, 8.0), 2: (1, 8.0), 3: (20, 160.0)}


def test_band_widens_and_covers(spark):
    """Random walks: errors grow with the horizon, and bands from the past hold
    the stated share of the future."""
    rng = np.random.default_rng(1)
    rows = [(f"e{k}", d, float(v)) for k in range(60) for d, v in zip(days(260), np.cumsum(rng.normal(0, 1, 260)))]
    train = spark.createDataFrame(rows, SCHEMA)
    paths = backtest.paths(train)
    found = backtest.errors(paths, train)
    steps = backtest.widths(found, 0.8)
    by = {}
    for r in steps.collect():
        by.setdefault(r.entity, {})[r.h] = r.width
    assert all(w[a] <= w[a + 1] for w in by.values() for a in range(1, 7))
    assert np.mean([w[7] for w in by.values()]) > 1.4 * np.mean([w[1] for w in by.values()])
    told = backtest.banded(forecast.predict(forecast.fit(train)), paths, steps).collect()
    assert all(r.yhat_upper - r.yhat == pytest.approx(by[r.entity][r.h]) for r in told) and len(told) == 420
    last = {e: y for e, d, y in rows if d == days(260)[-1]}
    assert all(abs(r.yhat - last[r.entity]) < 8 for r in told)
    shares = backtest.coverage(found, D0 + dt.timedelta(days=180), 0.8).collect()
    tried, covered = sum(r.tried for r in shares), sum(r.covered for r in shares)
    assert len(shares) == 7 and abs(covered / tried - 0.8) < 0.05


def test_band_without_errors_is_the_normal_one(spark):
    train = spark.createDataFrame([("s", d, float(i % 3)) for i, d in enumerate(days(10))], SCHEMA)
    plain = forecast.predict(forecast.fit(train))
    got = backtest.banded(plain, backtest.paths(train), backtest.widths(backtest.errors(backtest.paths(train), train))).orderBy("h").collect()
    for g, p in zip(got, plain.orderBy("h").collect(), strict=True):
        assert g[:3] == p[:3] and g[3:] == pytest.approx(p[3:])
