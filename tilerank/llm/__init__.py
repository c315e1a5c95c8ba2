"""Operators of a training-data pipeline on Spark. Importing the subpackage loads nothing; ``load_llm`` does."""

from __future__ import annotations


def load_llm() -> tuple[dict, dict]:
    """(queries, oracle SQL) of all operators here."""
    from . import queries
    from .common import ORACLES, QUERIES

    assert queries
    return QUERIES, ORACLES
