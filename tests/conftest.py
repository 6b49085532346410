import os
import re
from pathlib import Path

import pytest

from millrace.session import get_session


@pytest.fixture(scope="session")
def spark():
    s = get_session(os.environ.get("TEST_CPUS", "8"), 4, "tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def freed(spark):
    """Leaves some 250 MB freed in the JVM's C library, in pieces between few that stay; gives MB that the JVM holds beside its heap."""
    jvm = spark._jvm
    pid = jvm.java.lang.ProcessHandle.current().pid()

    def mb():
        total, counts = 0, False
        for line in Path(f"/proc/{pid}/smaps").read_text().splitlines():
            if m := re.match(r"([0-9a-f]+)-[0-9a-f]+ ", line):
                counts = int(m[1], 16) >= 32 << 30  # the Java heap lies below
            elif counts and (m := re.match(r"Private_Dirty:\s+(\d+)", line)):
                total += int(m[1])
        return total / 1024

    def leave():
        some = [jvm.java.util.zip.Deflater() for _ in range(3000)]
        kept.extend(some[::50])
        for i, d in enumerate(some):
            if i % 50:
                d.end()

    kept = []
    yield leave, mb
    for d in kept:
        d.end()
