from __future__ import annotations

import signal
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakewright.session import CHECKPOINT_SETTING, build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "lakewright-tests",
        "local[8]",
        **{
            "spark__ui__enabled": "false",
            "spark__sql__shuffle__partitions": "8",
            "spark__sql__warehouse__dir": tempfile.mkdtemp(prefix="lakewright-warehouse-"),
        },
    )
    if session.conf.get(CHECKPOINT_SETTING, None) is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lakewright-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


#: Seconds after which a test fails and its jobs are cancelled, so that one endless test does not take the others down.
LIMIT = 600


@pytest.hookimpl(wrapper=True)
def pytest_runtest_call(item):
    def give_up(*_: object) -> None:
        session = item.funcargs.get("spark")
        if session is not None:
            session.sparkContext.cancelAllJobs()
        raise TimeoutError(f"{item.nodeid} took more than {LIMIT} s")

    before = signal.signal(signal.SIGALRM, give_up)
    signal.alarm(LIMIT)
    try:
        return (yield)
    finally:
        signal.alarm(0)
        signal.signal(signal.SIGALRM, before)
