from __future__ import annotations

import datetime as dt
import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidecast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def demand(days: int = 100, cities=("Austin", "Chicago"), seed: int = 123) -> pd.DataFrame:
    """A small seeded panel ending on 2023-12-31."""
    rng = np.random.default_rng(seed)
    end = dt.date(2023, 12, 31)
    dates = [end - dt.timedelta(days=days - 1 - i) for i in range(days)]
    frames = []
    for i, city in enumerate(cities):
        weekday = np.array([d.weekday() for d in dates])
        rain = np.round(np.where(rng.random(days) < 0.3, rng.gamma(2, 4, days), 0.0), 2)
        promo = (rng.random(days) < 0.18).astype(int)
        level = 200 + 100 * i + 30 * (weekday >= 5) + 25 * promo
        frames.append(
            pd.DataFrame(
                {
                    "date": dates,
                    "city": city,
                    "orders": np.maximum(0, level + rng.normal(0, 10, days)).astype(int),
                    "temperature_c": np.round(15 + rng.normal(0, 5, days), 2),
                    "rainfall_mm": rain,
                    "is_rainy": (rain > 2).astype(int),
                    "is_holiday": (rng.random(days) < 0.03).astype(int),
                    "festival_flag": (rng.random(days) < 0.05).astype(int),
                    "promo_active": promo,
                }
            )
        )
    return pd.concat(frames, ignore_index=True)


PANEL_SCHEMA = (
    "date date, city string, orders bigint, temperature_c double, rainfall_mm double, is_rainy int, "
    "is_holiday int, festival_flag int, promo_active int"
)


@pytest.fixture(scope="session")
def panel_pdf():
    return demand()


@pytest.fixture(scope="session")
def panel(spark, panel_pdf):
    return spark.createDataFrame(panel_pdf, PANEL_SCHEMA).repartition(4).persist()


@pytest.fixture(scope="session")
def forecaster(spark, panel):
    from tidecast.operators.forecast import DemandForecaster

    return DemandForecaster(rounds=5).fit(panel)
