import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgertide.session import build_session, ensure_checkpoint_dir  # noqa: E402
from ledgertide.streaming.jobs import ROCKSDB  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
                                "spark.driver.memory": "4g", "spark.sql.streaming.stateStore.providerClass": ROCKSDB})
    session.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(session, str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()
