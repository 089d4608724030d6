"""Independent DuckDB SQL for every job, over the raw tables.

Written apart from the DataFrame code: money is whole cents, prices and discounts are integers, and
rounding is integer division. `tables` holds shared steps as named subqueries; a query gets the ones
it mentions.
"""

from __future__ import annotations

import re

from tradeloom.oracle.load import LOAD
from tradeloom.oracle.operations import OPERATIONS
from tradeloom.oracle.reports import REPORTS
from tradeloom.oracle.tables import TABLES


def _needed(text: str) -> list[str]:
    """Names of the shared subqueries a text mentions, dependencies first."""
    found: list[str] = []

    def visit(sql: str) -> None:
        words = set(re.findall(r"\w+", sql))
        for name, body in TABLES.items():
            if name in words and name not in found:
                visit(body)
                if name not in found:
                    found.append(name)

    visit(text)
    return found


def oracle_queries() -> dict[str, str]:
    queries = {}
    for name, text in {**LOAD, **REPORTS, **OPERATIONS}.items():
        shared = ",\n".join(f"{table} as ({TABLES[table].strip()})" for table in _needed(text))
        queries[name] = f"with recursive {shared}\n{text.strip()}" if shared else text.strip()
    return queries
