"""Training-data operators: one module per operator, each with its query and, where SQL can say it, its check.

Nothing else in the library imports this package.
"""

from __future__ import annotations

from touchgrid.llm import (
    bandjoin, chat, decontaminate, hardneg, heapmeans, htmlcut, langid, linededup, pieces, pivotdups, quality,
    shards, topk,
)

MODULES = (
    quality, langid, linededup, htmlcut, pieces, bandjoin, chat, topk, decontaminate, shards, heapmeans, pivotdups, hardneg,
)


def queries() -> dict:
    """Every registered query of the package by name."""
    return {name: fn for m in MODULES for name, fn in m.QUERIES.items()}


def oracles() -> dict:
    """The SQL checks, for those queries that SQL can express."""
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
