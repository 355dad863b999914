"""The subpackage's queries and their DuckDB twins."""

from __future__ import annotations

from importlib import import_module

#: Modules with QUERIES (name -> function of (spark, sf_dir)) and ORACLES (name -> SQL).
MODULES = [
    "q01_chat", "q02_urls", "q03_jaccard", "q04_quality", "q05_toxicity", "q06_exact", "q07_huffman", "q08_vectors",
    "q09_sentencepiece", "q10_packing", "q11_repair", "q12_mixing", "q13_merkle",
]


def _gather(what: str) -> dict:
    found: dict = {}
    for name in MODULES:
        found.update(getattr(import_module(f"{__package__}.{name}"), what))
    return found


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("ORACLES")
