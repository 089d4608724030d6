from __future__ import annotations

import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradeloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tradeloom-tests", cores=8)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """frame("a int, b string", (1, "x"), ...) as a DataFrame."""

    def make(schema: str, *rows: tuple):
        return spark.createDataFrame(list(rows), schema)

    return make


def as_dicts(df) -> list[dict]:
    return [row.asDict() for row in df.collect()]


def by(df, *keys: str) -> dict:
    """Rows as dictionaries, found by key; the key must be unique."""
    found = {}
    for row in as_dicts(df):
        key = row[keys[0]] if len(keys) == 1 else tuple(row[name] for name in keys)
        assert key not in found, f"two rows for {key}"
        found[key] = row
    return found


def d(text: str | None) -> Decimal | None:
    return None if text is None else Decimal(text)
