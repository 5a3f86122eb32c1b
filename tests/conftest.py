import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from adlake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session("tests", cores="4", shuffle_partitions=4, checkpoint_dir=shared)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of dicts."""

    def collect(df, *by):
        out = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(out, key=lambda r: [str(r[b]) for b in by]) if by else out

    return collect


def ts(text):
    return dt.datetime.fromisoformat(text)
