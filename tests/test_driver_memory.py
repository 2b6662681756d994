"""Memory that the driver has freed goes back to the system."""

import gc
import re
import time
from pathlib import Path

import pytest

from loomsift import session


def _anonymous_mb(pid):
    return int(re.search(r"RssAnon:\s+(\d+)", Path(f"/proc/{pid}/status").read_text())[1]) / 1024


@pytest.mark.skipif(not Path("/proc/self/status").exists(), reason="needs /proc")
def test_reclaim_returns_the_jvms_freed_native_memory(spark):
    pid = spark._jvm.java.lang.ProcessHandle.current().pid()
    before = _anonymous_mb(pid)
    # Pieces too small to be mapped on their own; one of the last stays and pins the rest.
    pieces = [spark._jvm.java.nio.ByteBuffer.allocateDirect(60_000) for _ in range(2500)]
    last = pieces[-1]
    del pieces
    grown = _anonymous_mb(pid) - before
    for _ in range(2):  # what a collection frees, the next call returns at the latest
        gc.collect()
        session._reclaimed = 0.0
        session.reclaim(spark)
        time.sleep(1)
    assert last.capacity() == 60_000
    assert grown > 60
    assert _anonymous_mb(pid) - before < grown / 2
