from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayline.schemas import FEATURE_USAGE, SUPPORT_TICKETS, USERS  # noqa: E402
from stayline.session import local_session  # noqa: E402

AS_OF = dt.date(2025, 6, 30)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "tests", "8",
        **{
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    yield session
    session.stop()


class Tables:
    """Small hand-made inputs; unnamed fields get harmless defaults."""

    def __init__(self, spark):
        self.spark = spark

    def users(self, *rows):
        base = dict(country="Colombia", plan="Pro", signup_date=dt.date(2024, 1, 1),
                    source="Paid", mrr_usd=50, churn_risk_score=0.5, features_count=1)
        return self._frame(USERS, base, rows)

    def usage(self, *rows):
        base = dict(feature="Inventario", adoption_level="power_user", last_used_date=AS_OF)
        return self._frame(FEATURE_USAGE, base, rows)

    def tickets(self, *rows):
        base = dict(category="Bug", priority="Low", channel="Chat",
                    created_date=dt.date(2025, 1, 1), resolved_date=None, status="Resolved",
                    resolution_hours=None, csat_score=None)
        return self._frame(SUPPORT_TICKETS, base, rows)

    def _frame(self, schema, base, rows):
        from decimal import Decimal

        out = []
        for row in rows:
            values = {**base, **row}
            for name in ("mrr_usd", "churn_risk_score"):
                if values.get(name) is not None and name in values:
                    values[name] = Decimal(str(values[name])).quantize(Decimal("0.01"))
            out.append(tuple(values.get(n) for n in schema.names))
        return self.spark.createDataFrame(out, schema)


@pytest.fixture(scope="session")
def make(spark):
    return Tables(spark)


@pytest.fixture(scope="session")
def as_of():
    return AS_OF


def by_user(df, *columns):
    rows = df.select("user_id", *columns).collect()
    if len(columns) == 1:
        return {r.user_id: r[columns[0]] for r in rows}
    return {r.user_id: tuple(r[c] for c in columns) for r in rows}
