import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskgraph.session import local_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session(os.environ.get("TEST_CPUS", "*"), shuffle_partitions=8, app_name="riskgraph-tests",
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="rg-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def outdir():
    return tempfile.mkdtemp(prefix="rg-test-out-")


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()),
                  key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))
