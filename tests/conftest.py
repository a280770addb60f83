from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from facetrank.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[*]",
        {
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            # Plans in full, for the tests that read them.
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


class Bag(list):
    """A list that equals another in any order."""

    def __eq__(self, other):
        return list(self) == sorted(other, key=repr)

    __hash__ = None


def rows(df, *columns) -> Bag:
    """Rows as tuples, arrays as tuples, without an order of their own."""
    chosen = df.select(*columns) if columns else df

    def plain(value):
        return tuple(value) if isinstance(value, list) else value

    return Bag(sorted((tuple(plain(v) for v in row) for row in chosen.collect()), key=repr))


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
