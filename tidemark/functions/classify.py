"""Ordered threshold classification (first matching rule wins, NULL -> default)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# The label texts and thresholds of the original pipeline.
# Tiers of the daily change in percent, tested in this order:
#   > 2 "🔥 Forte Alta", > 1 "⚡ Em Alta", < -2 "❄️ Forte Baixa",
#   < -1 "📉 Em Baixa", otherwise "➡️ Estável".
# Risk of the rounded volatility:
#   > 3 "🔴 Alto", > 1.5 "🟡 Médio", otherwise "🟢 Baixo".
# ---------------------------------------------------------------------------
TIER_LABELS = {
    "strong_up": "🔥 Forte Alta",
    "up": "⚡ Em Alta",
    "strong_down": "❄️ Forte Baixa",
    "down": "📉 Em Baixa",
    "stable": "➡️ Estável",
}
RISK_LABELS = {
    "high": "🔴 Alto",
    "medium": "🟡 Médio",
    "low": "🟢 Baixo",
}

Rule = tuple[str, float, str]  # (">" or "<" or ">=" or "<=", threshold, label)


def tier_rules(strong: float = 2.0, mild: float = 1.0, labels: dict[str, str] = TIER_LABELS):
    """Rules and default label for performance tiers with symmetric thresholds."""
    rules: list[Rule] = [
        (">", strong, labels["strong_up"]),
        (">", mild, labels["up"]),
        ("<", -strong, labels["strong_down"]),
        ("<", -mild, labels["down"]),
    ]
    return rules, labels["stable"]


def risk_rules(high: float = 3.0, medium: float = 1.5, labels: dict[str, str] = RISK_LABELS):
    rules: list[Rule] = [(">", high, labels["high"]), (">", medium, labels["medium"])]
    return rules, labels["low"]


TIER_RULES = tier_rules()
RISK_RULES = risk_rules()

_OPS = {
    ">": lambda c, t: c > t,
    "<": lambda c, t: c < t,
    ">=": lambda c, t: c >= t,
    "<=": lambda c, t: c <= t,
}


def classify(col: Column | str, rules: Sequence[Rule], default: str) -> Column:
    """CASE WHEN chain in rule order; a NULL input falls through to ``default``."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for op, threshold, label in rules:
        cond = _OPS[op](c, F.lit(threshold))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))
