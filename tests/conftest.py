import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session
    s = build_session("local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="strata-test-")})
    yield s
    s.stop()


@pytest.fixture
def json_dir(tmp_path):
    """Write JSON lines (one string per row) into a fresh directory; return its path."""
    counter = {"n": 0}

    def write(lines, name=None):
        counter["n"] += 1
        d = tmp_path / (name or f"src{counter['n']}")
        d.mkdir(parents=True, exist_ok=True)
        (d / f"part-{counter['n']:03d}.json").write_text("\n".join(lines) + "\n")
        return str(d)
    return write
