import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickerloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def bars_pandas():
    """Two tickers of uneven length with a few gaps between dates."""
    import numpy as np
    import pandas as pd

    draw = np.random.default_rng(7)
    frames = []
    for ticker, rows in (("AAA", 140), ("BBB", 75)):
        dates = pd.bdate_range("2024-01-02", periods=rows)
        close = 100 * np.cumprod(1 + draw.normal(0, 0.02, rows))
        high, low = close * (1 + draw.uniform(0, 0.02, rows)), close * (1 - draw.uniform(0, 0.02, rows))
        frames.append(
            pd.DataFrame(
                {
                    "ticker": ticker,
                    "date": dates.date,
                    "open": (high + low) / 2,
                    "high": high,
                    "low": low,
                    "close": close,
                    "volume": draw.integers(100, 1000, rows).astype(float),
                }
            )
        )
    return pd.concat(frames, ignore_index=True)


@pytest.fixture(scope="session")
def bars(spark, bars_pandas):
    from tickerloom import schemas

    return spark.createDataFrame(bars_pandas[schemas.BARS.names], schemas.BARS)
