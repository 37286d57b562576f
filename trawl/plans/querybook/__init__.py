"""The registered queries: each operator over the whole given tables, with the
equivalent DuckDB SQL where there is one."""

from __future__ import annotations

from trawl.plans.querybook import entities, filters, search, store  # noqa: F401
from trawl.plans.querybook.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
