import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from arterial.session import build_session
    from arterial.streaming.queries import STATE_STORE

    session = build_session(
        "arterial-tests",
        "local[8]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            **STATE_STORE,
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def readings(spark):
    from arterial.plans import views

    return views.readings(spark, SF_DIR).cache()


@pytest.fixture(scope="session")
def gps(spark):
    from arterial.plans import views

    return views.gps_points(spark, SF_DIR).cache()
