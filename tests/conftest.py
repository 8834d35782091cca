import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from barworks.functions.schema import BARS, TIMEFRAME_SECONDS  # noqa: E402
from barworks.operators import positions  # noqa: E402
from barworks.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    # many small plans: compiling them costs more than running them
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture
def layout(monkeypatch):
    """Buckets and blocks so small that every series crosses many."""
    monkeypatch.setattr(positions, "SLOTS", 7)
    monkeypatch.setattr(positions, "BLOCK", 16)


@pytest.fixture
def bars(spark):
    """Bars from close values: `bars(close)`, or with any column given by name."""
    def build(close, pair="A/B", timeframe="1h", start=datetime(2024, 1, 1), at=None, **given):
        step = timedelta(seconds=TIMEFRAME_SECONDS.get(timeframe, 3600))
        rows = []
        for i, c in enumerate(close):
            base = 1.0 if c is None else float(c)
            row = {"open": base, "high": base + 1, "low": base - 1, "close": None if c is None else float(c), "volume": 5.0}
            row.update({k: v[i] for k, v in given.items()})
            when = at[i] if at else start + i * step
            rows.append((pair, timeframe, when, row["open"], row["high"], row["low"], row["close"], row["volume"]))
        return spark.createDataFrame(rows, BARS)
    return build


def column(df, name, order="timestamp"):
    return [r[name] for r in df.orderBy("pair", order).collect()]
