import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from comptoir.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="comptoir-test-ckpt-")
    s = build(master="local[4]", shuffle_partitions=8,
              extra={"spark.checkpoint.dir": ckpt, "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wh-")})
    yield s
    s.stop()


def rows(df, *cols):
    """Collected rows as tuples (optionally a subset of columns), sorted with NULLs first."""
    d = df.select(*cols) if cols else df
    return sorted([tuple(r) for r in d.collect()], key=lambda t: tuple((x is not None, str(x)) for x in t))
