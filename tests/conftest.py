from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from snapshot_rows import STATISTICS_DEFAULTS  # noqa: E402

from tierline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def folder(spark):
    from tierline.session import fresh_path

    return lambda label: fresh_path(spark, f"test-{label}")


@pytest.fixture()
def history(spark):
    """History rows from a few given values each; the rest takes defaults."""

    def make(*rows: dict, extra: str = ""):
        names = [*STATISTICS_DEFAULTS, *[e.split()[0] for e in extra.split(",") if e]]
        schema = ", ".join(f"{n} string" for n in STATISTICS_DEFAULTS) + (f", {extra}" if extra else "")
        return spark.createDataFrame([tuple({**STATISTICS_DEFAULTS, **r}.get(n) for n in names) for r in rows], schema)

    return make
