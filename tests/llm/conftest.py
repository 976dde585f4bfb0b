from __future__ import annotations

import pytest

from tests.conftest import make_session


@pytest.fixture(scope="session")
def spark():
    return make_session()


@pytest.fixture
def docs(spark):
    """Documents with columns whose names the operators use themselves."""

    def make(rows, extra=True):
        frame = spark.createDataFrame(list(rows), "doc_id long, text string")
        if extra:
            for name in ("words", "score", "block", "n_words", "norm", "kept", "bands", "digest"):
                frame = frame.selectExpr("*", f"'x' AS {name}")
        return frame

    return make
