import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from navspan.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session({
        "warehouse_dir": str(tmp_path_factory.mktemp("warehouse")),
        "master": "local[8]", "shuffle_partitions": 8, "app_name": "tests",
        "spark.ui.enabled": "false", "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
