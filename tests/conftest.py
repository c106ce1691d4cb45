import os
import sys
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark__ui__enabled": "false", "spark__driver__memory": "8g", "spark__ui__showConsoleProgress": "false",
        "spark__checkpoint__dir": str(tmp_path_factory.mktemp("shared")), "spark__sql__warehouse__dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = build_session("tickloom-tests", "local[8]", 4, **conf)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def price_series(days: int = 260, ticker: str = "AAPL", seed: int = 42) -> pd.DataFrame:
    """Deterministic daily bars."""
    rng = np.random.RandomState(seed)
    close = np.round(100 + rng.randn(days).cumsum(), 2)
    return pd.DataFrame({
        "ticker": ticker, "date": [date(2020, 1, 1) + timedelta(days=i) for i in range(days)],
        "open": np.round(close + rng.randn(days) * 0.3, 2), "high": np.round(close + 1 + rng.rand(days), 2),
        "low": np.round(close - 1 - rng.rand(days), 2), "close": close, "volume": rng.randint(1_000_000, 9_000_000, days).astype("int64"),
    })


@pytest.fixture(scope="session")
def bars_pdf():
    return pd.concat([price_series(), price_series(180, "GOOGL", 7)], ignore_index=True)


@pytest.fixture(scope="session")
def bars(spark, bars_pdf):
    return spark.createDataFrame(bars_pdf).cache()
