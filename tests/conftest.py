import os
import sys
from pathlib import Path

# The JVM's own zone can leak into conversions, so it is fixed as well.
os.environ.setdefault("TZ", "UTC")
os.environ["JAVA_TOOL_OPTIONS"] = f"{os.environ.get('JAVA_TOOL_OPTIONS', '')} -Duser.timezone=UTC"
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import pytest  # noqa: E402

from sensorloom.session import telemetry_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = telemetry_session(
        "sensorloom-tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "2",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
