"""Every registered query of the catalog runs to its end on the smallest tables."""

from __future__ import annotations

import os

import pytest

from catalog import base
from catalog import matching, papers, rows, text  # noqa: F401  (importing registers the queries)

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(base.QUERIES))
def test_query_runs(spark, name):
    frame = base.QUERIES[name](spark, FOLDER)
    assert len(frame.columns) == len(set(frame.columns))
    frame.write.format("noop").mode("overwrite").save()
