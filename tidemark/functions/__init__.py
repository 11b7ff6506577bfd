"""Column builders: each returns a ``pyspark.sql.Column`` made of built-ins."""

from tidemark.functions.classify import (
    RISK_LABELS,
    RISK_RULES,
    TIER_LABELS,
    TIER_RULES,
    classify,
    risk_rules,
    tier_rules,
)
from tidemark.functions.hashing import content_hash, hash_text
from tidemark.functions.numeric import format_pct, pct_change, to_double, to_money
from tidemark.functions.timeparse import format_rfc2822, parse_rfc2822

__all__ = [
    "RISK_LABELS",
    "RISK_RULES",
    "TIER_LABELS",
    "TIER_RULES",
    "classify",
    "risk_rules",
    "tier_rules",
    "content_hash",
    "hash_text",
    "format_pct",
    "pct_change",
    "to_double",
    "to_money",
    "format_rfc2822",
    "parse_rfc2822",
]
