"""Queries and oracle statements of the training-data operators."""

from __future__ import annotations

from candlewick.sources.tables import load

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f
    return add


from candlewick.llm import queries  # noqa: E402,F401
