"""Incremental gold equals the full recompute, whatever arrives when."""

import json
import random

import pytest

import sample_docs

CODES = sample_docs.CODES[:6]
COLUMNS = ["code_exchange_rate", "time_last_update_utc", "exchange_rate", "prev_value", "daily_change_pct",
           "weekly_change_pct", "monthly_change_pct"]


def same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_arrival_order(spark, tmp_dir, seed):
    from tidemark.plans.gold import run_gold, run_gold_incremental
    from tidemark.plans.silver import write_silver
    from tidemark.sources.snapshots import read_snapshots, snapshot_days

    rng = random.Random(seed)
    docs = []
    for day, values in sample_docs.rates().items():
        # some codes miss a day, one code appears late, one ends early
        kept = {c: v for c, v in values.items() if c in CODES and rng.random() < 0.95}
        if day < sample_docs.DAYS[20]:
            kept.pop(CODES[1], None)
        if day > sample_docs.DAYS[25]:
            kept.pop(CODES[2], None)
        docs.append(sample_docs.document(day, kept))
    late = docs.pop(7 + seed)
    batches = [docs[:20], docs[20:36], [late], docs[36:] + docs[30:32], []]
    silver, gold, full = f"{tmp_dir}/silver", f"{tmp_dir}/gold", f"{tmp_dir}/full"
    for i, batch in enumerate(batches):
        path = f"{tmp_dir}/raw{i}.json"
        with open(path, "w") as f:
            f.writelines(json.dumps(d) + "\n" for d in batch)
        raw = read_snapshots(spark, path, multiline=False)
        write_silver(raw, silver)
        got = run_gold(spark, silver, gold) if i == 0 else run_gold_incremental(spark, silver, gold, snapshot_days(raw))
        want = run_gold(spark, silver, full)
        assert same(got["performance"].select(COLUMNS), want["performance"].select(COLUMNS)), i
        for name in ("currency_heatmap", "top_gainers", "top_losers", "volatility_exchange_rates"):
            assert same(got[name], want[name]), (i, name)


@pytest.mark.parametrize("first", [[0, 1, 2], [0, 1, 2, "none"]])
def test_rows_without_a_time(spark, tmp_dir, first):
    """A snapshot whose time can't be parsed changes lags as in the full run,
    and rows that come after it do."""
    from tidemark.plans.gold import run_gold, run_gold_incremental
    from tidemark.plans.silver import write_silver
    from tidemark.sources.snapshots import read_snapshots, snapshot_days

    rates = list(sample_docs.rates().items())

    def document(i):
        if not isinstance(i, str):
            return sample_docs.document(rates[i][0], {c: rates[i][1][c] for c in CODES[:4]})
        # the second comes with a code that has no history, too
        some = {c: 1.5 + len(i) for c in ([CODES[1], CODES[5]] if i == "none" else [CODES[2]])}
        return sample_docs.document(rates[0][0], some) | {"time_last_update_utc": f"no time: {i}"}

    silver, gold, full = f"{tmp_dir}/silver", f"{tmp_dir}/gold", f"{tmp_dir}/full"
    for n, batch in enumerate([first, [3, 4, "none"], [5, "again", "none"], [6]]):
        path = f"{tmp_dir}/raw{n}.json"
        with open(path, "w") as f:
            f.writelines(json.dumps(document(i)) + "\n" for i in batch)
        raw = read_snapshots(spark, path, multiline=False)
        write_silver(raw, silver)
        got = run_gold_incremental(spark, silver, gold, snapshot_days(raw)) if n else run_gold(spark, silver, gold)
        want = run_gold(spark, silver, full)
        assert same(got["performance"].select(COLUMNS), want["performance"].select(COLUMNS)), n
        for name in ("currency_heatmap", "top_gainers", "top_losers", "volatility_exchange_rates"):
            assert same(got[name], want[name]), (n, name)
