from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tideline.session import build_session  # noqa: E402

T0 = datetime(2024, 3, 1, 9, 30)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tideline-tests", cores=4, spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def minutes(n: float) -> datetime:
    return T0 + timedelta(minutes=n)


TICK_SCHEMA = "tick_id long, time timestamp_ntz, symbol string, price double, volume double"


def make_ticks(spark, rows):
    """Ticks from (minutes, symbol, price, volume) tuples."""
    data = [(i, minutes(m), s, float(p), float(v)) for i, (m, s, p, v) in enumerate(rows)]
    return spark.createDataFrame(data, TICK_SCHEMA)


def random_ticks(spark, n=600, symbols=("A", "B", "C"), seed=7, hot=None):
    """Ticks at random times; ``hot`` is a symbol that gets about half of them."""
    import random

    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        symbol = hot if hot and rng.random() < 0.5 else rng.choice(symbols)
        rows.append((rng.randrange(0, 3 * 1440 * 60) / 60, symbol, rng.randrange(1, 9999) / 100, rng.randrange(0, 50)))
    return make_ticks(spark, rows)


def plain(df, *order, digits=6):
    """Rows as sorted tuples with rounded doubles."""
    def clean(v):
        v = float(v) if isinstance(v, Decimal) else v
        return round(v, digits) + 0.0 if isinstance(v, float) else v

    columns = order or df.columns
    rows = [tuple(clean(v) for v in r) for r in df.select(*columns).collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", "") for v in r))


def plan_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
