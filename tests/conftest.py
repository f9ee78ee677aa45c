from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import build_session

    root = tmp_path_factory.mktemp("spark")
    s = build_session(
        "local[4]",
        app_name="tidemark-tests",
        shuffle_partitions=4,
        conf={
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.checkpoint.dir": str(root / "checkpoints"),
        },
    )
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"
