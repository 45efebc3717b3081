import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.paths import Layout  # noqa: E402
from tidemark.session import build_session, scratch  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="tidemark-tests", shuffle_partitions=8)
    yield s
    s.stop()


def _folder(request) -> str:
    # parametrized ids like "[merge]" would be read as glob patterns in paths
    return re.sub(r"[^A-Za-z0-9_]", "_", f"test_{request.node.name}")[:60]


@pytest.fixture
def layout(spark, request):
    return Layout(scratch(spark, _folder(request)))


@pytest.fixture
def root(spark, request):
    return scratch(spark, _folder(request))


def rows(df, cols=None):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
