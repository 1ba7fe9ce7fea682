"""Training-data queries at the smallest scale against their SQL twins."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline as pipeline
from compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(pipeline.SQL))
def test_query(spark, con, name):
    assert difference(spark, con, name, pipeline.QUERIES[name], pipeline.SQL[name], SF) == ""


def test_one_query_per_operator():
    found = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in pipeline.QUERIES if n != "pipeline")
    assert found == list(range(1, 14))
