"""Every registered query against its SQL counterpart, on the smallest tables."""

from __future__ import annotations

import pytest
from compare import compare, data_dir

from folioworks.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    assert compare(spark, name, data_dir("0.001")) is None


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
