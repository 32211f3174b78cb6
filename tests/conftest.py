from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from timbrel.session import build_session, ship_package

    # functions of the test modules run in the workers, too
    os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT / "tests"), os.environ.get("PYTHONPATH", "")])

    session = build_session(
        "tests",
        "local[8, 3]",  # a failed task is tried again
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()
