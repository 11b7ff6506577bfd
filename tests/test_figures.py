"""Figures of the profiles: means, NaN, missing values and their texts."""

import pytest

from tidemark.operators import profile


def frame(spark, rows):
    return spark.createDataFrame(rows, "entity string, daily_change_pct double")


def test_small_values_keep_their_mean(spark):
    row = profile.change_stats(frame(spark, [("a", 1e-12), ("a", 3e-12)]), "entity").first()
    assert row["avg_change"] == pytest.approx(2e-12) and row["volatility"] == pytest.approx(2**0.5 * 1e-12)


def test_nan_is_missing_in_every_figure(spark):
    rows = [("a", 1.0), ("a", float("nan")), ("a", 3.0), ("b", float("nan"))]
    got = {r["entity"]: r for r in profile.change_stats(frame(spark, rows), "entity").collect()}
    assert tuple(got["a"])[1:] == (2.0, pytest.approx(2**0.5), 3.0, 1.0)
    assert tuple(got["b"])[1:] == (None, None, None, None)
    kpi = profile.kpi_summary(frame(spark, rows)).first()
    assert (kpi["entities"], kpi["avg_change"], kpi["max_gain"], kpi["max_loss"]) == (4, 2.0, 3.0, 1.0)
    vol = profile.volatility_profile(frame(spark, rows), "entity").collect()
    assert {(r["entity"], r["avg_change"], r["max_gain"]) for r in vol} == {("a", 2.0, 3.0), ("b", None, None)}


def test_missing_figures_have_a_text(spark):
    df = frame(spark, [("a", 1.005), (None, None)])
    text = {r["entity"]: r["summary"] for r in profile.stats_sentences(profile.change_stats(df, "entity"), "entity").collect()}
    assert text["a"].startswith("a: mean daily change 1.01%, volatility n/a, best day")
    assert text[None] == "n/a: mean daily change n/a, volatility n/a, best day n/a, worst day n/a."
    kpi = profile.kpi_summary(df.limit(0)).first()
    assert (kpi["avg_change_text"], kpi["max_gain_text"], kpi["max_loss_text"]) == ("n/a", "n/a", "n/a")
