import glob
import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tessera.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # The event log (in a fresh scratch folder) lets tests read shuffle volumes.
    events = tempfile.mkdtemp(prefix="tessera-eventlog-")
    session = local_session(
        cores="*",
        shuffle_partitions=8,
        app="tessera-tests",
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": events, "spark.eventLog.compress": "false"},
    )
    yield session
    session.stop()


@pytest.fixture
def scratch():
    """A fresh folder per test (never removed by the tests)."""
    return tempfile.mkdtemp(prefix="tessera-test-")


@pytest.fixture(scope="session")
def sf001():
    return SF001


@pytest.fixture(scope="session")
def sf01():
    return SF01


@pytest.fixture(scope="session")
def event_log(spark):
    """A function that returns the events written so far by the test
    session's event log."""

    def read() -> list[dict]:
        log_dir = spark.conf.get("spark.eventLog.dir").replace("file:", "")
        found = glob.glob(f"{log_dir}/*{spark.sparkContext.applicationId}*")
        files = [f for p in found for f in (sorted(glob.glob(f"{p}/events_*")) if os.path.isdir(p) else [p])]
        events = []
        for path in files:
            with open(path, encoding="utf-8") as fh:
                for line in fh:
                    try:
                        events.append(json.loads(line))
                    except ValueError:  # a line still being written
                        break
        return events

    return read
