"""Gold after runs that ended anywhere equals the full recompute."""

import json

import pytest

import sample_docs
from test_gold_incremental import CODES, COLUMNS, same

from tidemark.operators import profile, state
from tidemark.plans import gold as G
from tidemark.plans.pipeline import run_pipeline
from tidemark.sources import ledger

TABLES = ("currency_heatmap", "top_gainers", "top_losers", "volatility_exchange_rates")


class Stopped(Exception):
    pass


def landed(tmp_dir, name, days, codes=CODES[:4], cut=None):
    rates = list(sample_docs.rates().items())
    path = f"{tmp_dir}/{name}.json"
    with open(path, "w") as f:
        for i in days:
            values = {c: rates[i][1][c] for c in codes if (i, c) != cut}
            f.write(json.dumps(sample_docs.document(rates[i][0], values)) + "\n")
    return path


def stopping(monkeypatch, n):
    """The n-th write or note from now on ends the run, once."""
    left = [n]

    def wrap(module, name, at_end):
        real = getattr(module, name)

        def call(*a, **k):
            if at_end:
                out = real(*a, **k)
            if left[0] == 0:
                left[0] = -1
                raise Stopped(name)
            left[0] -= left[0] > 0
            return out if at_end else real(*a, **k)

        monkeypatch.setattr(module, name, call)

    for name in ("write_overwrite", "write_partitions"):
        wrap(G, name, True)
    wrap(G.ingest, "append_new", True)
    wrap(G.ledger, "put", False)
    wrap(G.ledger, "remove", False)
    return left


def check(spark, got, silver, tmp_dir):
    want = G.run_gold(spark, silver, f"{tmp_dir}/full")
    assert same(got["performance"].select(COLUMNS), want["performance"].select(COLUMNS))
    for name in TABLES:
        assert same(got[name], want[name]), name


@pytest.mark.parametrize("late", [False, True])
def test_a_run_may_end_after_any_step(spark, tmp_dir, monkeypatch, late):
    """Days 0 to 4, then a batch whose run is ended at ever later steps (with a
    late row or not), and at the end a batch after it."""
    step, stops = 0, []
    while True:
        where = f"{tmp_dir}/{step}"
        import os

        os.makedirs(where)
        silver, gold = f"{where}/silver", f"{where}/gold"
        run_pipeline(spark, landed(where, "a", range(5), cut=(2, CODES[1]) if late else None), silver, gold, multiline=False)
        second = landed(where, "b", [2, 5] if late else [5])
        with monkeypatch.context() as m:
            left = stopping(m, step)
            try:
                run_pipeline(spark, second, silver, gold, multiline=False)
            except Stopped as e:
                stops.append(str(e))
        # the next run gets other days only, and finishes what was left
        got = run_pipeline(spark, landed(where, "c", [6]), silver, gold, multiline=False)
        check(spark, got, silver, where)
        assert ledger.notes(spark, f"{gold}/_due") == {} and ledger.notes(spark, f"{gold}/_steps") == {}
        if left[0] >= 0:
            break
        step += 4 if step else 2
    assert len(stops) >= 3


def test_a_full_run_that_ended_is_no_base(spark, tmp_dir, monkeypatch):
    silver, gold = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    run_pipeline(spark, landed(tmp_dir, "a", range(4)), silver, gold, multiline=False)
    with monkeypatch.context() as m:
        m.setattr(G, "_tails", lambda rows: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            G.run_gold(spark, silver, gold)
    assert "full" in ledger.notes(spark, f"{gold}/_steps")
    check(spark, run_pipeline(spark, landed(tmp_dir, "b", [4]), silver, gold, multiline=False), silver, tmp_dir)


def test_on_time_runs_read_no_old_day(spark, tmp_dir):
    """The volatility comes from the moments: its plan has no performance scan,
    and old performance files may be gone."""
    silver, gold = f"{tmp_dir}/silver", f"{tmp_dir}/gold"
    run_pipeline(spark, landed(tmp_dir, "a", range(8)), silver, gold, multiline=False)
    tables = G.gold_tables(spark.read.parquet(f"{gold}/performance.parquet"), moments=spark.read.parquet(f"{gold}/moments.parquet"))
    plan = tables["volatility_exchange_rates"]._jdf.queryExecution().optimizedPlan().toString()
    assert "daily_change_pct" not in plan and "m2" in plan


def test_claim_is_given_once(spark, tmp_dir):
    assert [ledger.claim(spark, f"{tmp_dir}/l", "x", t) for t in ("one", "two")] == [True, False]
    assert ledger.notes(spark, f"{tmp_dir}/l") == {"x": "one"}
    ledger.remove(spark, f"{tmp_dir}/l", "x")
    ledger.remove(spark, f"{tmp_dir}/l", "x")
    assert ledger.notes(spark, f"{tmp_dir}/l") == {} and ledger.notes(spark, f"{tmp_dir}/none") == {}


def test_merged_moments_equal_the_profile(spark):
    import random

    rng = random.Random(4)
    nan = float("nan")
    rows = [(rng.choice(["a", "b", "c", None, "one"][: rng.randint(1, 5)]), rng.choice([None, nan, round(rng.gauss(0, 3), 2)])) for _ in range(400)]
    rows += [("only null", None), ("only nan", nan), ("single", 1.25)]
    df = spark.createDataFrame(rows, "entity string, daily_change_pct double")
    want = sorted(map(tuple, profile.volatility_profile(df, "entity").collect()), key=repr)
    for size in (1, 2, 7):
        table = state.moments(df.limit(0), "entity")
        for i in range(size):
            table = state.merge(table, state.moments(spark.createDataFrame(rows[i::size], df.schema), "entity"), "entity")
        assert sorted(map(tuple, state.volatility_from_moments(table, "entity").collect()), key=repr) == want
