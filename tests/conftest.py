import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from parcelsight.session import build_session

    session = build_session(
        "parcelsight-tests",
        master="local[*]",
        shuffle_partitions=8,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from parcelsight.sources.scratch import release

    release(session)
    session.stop()
