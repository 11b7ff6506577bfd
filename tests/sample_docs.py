"""Snapshot documents in the API's layout, generated: 163 codes (integer and
decimal rates), 40 days, one day delivered twice."""

import datetime as dt
import json
import random
import tempfile
from email.utils import format_datetime

CODES = ["USD", *sorted(f"{a}{b}{c}" for a in "ABCDEF" for b in "GHIJKL" for c in "MNOPQ")[:162]]
DAYS = [dt.date(2025, 10, 1) + dt.timedelta(days=i) for i in range(40)]


def rates() -> dict[dt.date, dict[str, float]]:
    """A random walk of each code; the same on every call."""
    rng = random.Random(20251001)
    now = {c: 1 if c == "USD" else round(rng.uniform(0.2, 900), 4) for c in CODES}
    out = {}
    for day in DAYS:
        out[day] = dict(now)
        for i, c in enumerate(CODES[1:]):
            step = rng.gauss(0, 0.002 if i % 9 else 0.03)
            now[c] = max(0.0101, round(now[c] * (1 + step), 4))
    return out


def document(day: dt.date, values: dict) -> dict:
    at = dt.datetime(day.year, day.month, day.day, 0, 0, 1, tzinfo=dt.timezone.utc)
    nxt = at + dt.timedelta(days=1)
    return {
        "result": "success",
        "documentation": "https://quotes.example.org/docs",
        "terms_of_use": "https://quotes.example.org/terms",
        "time_last_update_unix": int(at.timestamp()),
        "time_last_update_utc": format_datetime(at),
        "time_next_update_unix": int(nxt.timestamp()),
        "time_next_update_utc": format_datetime(nxt),
        "base_code": "USD",
        "conversion_rates": values,
    }


def write() -> str:
    """A folder of 41 files: one a day, the last day's payload again a day later."""
    folder = tempfile.mkdtemp(prefix="tidemark-samples-")
    for file_day, (day, values) in zip([*DAYS, DAYS[-1] + dt.timedelta(days=1)],
                                       [*rates().items(), list(rates().items())[-1]], strict=True):
        with open(f"{folder}/exchange_rates_{file_day}.json", "w") as f:
            json.dump(document(day, values), f, indent=2)
    return folder
