"""Every registered query against its SQL on the smallest test tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle_check import difference  # noqa: E402

from ledgerspark.catalogue.oracles import ORACLES  # noqa: E402
from ledgerspark.catalogue.queries import QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, name):
    assert difference(spark, FOLDER, name) is None
