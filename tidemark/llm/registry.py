"""The queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from tidemark.llm import (
    bpe, decontam, extract, fim, jaccard, langid, lattice, merkle, mixing, quality, search, secrets, warc,
)

MODULES = (quality, langid, decontam, jaccard, extract, secrets, warc, bpe, merkle, lattice, mixing, search, fim)

QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
ORACLE_SQL = {name: q for m in MODULES for name, q in getattr(m, "ORACLE_SQL", {}).items()}
