"""Every registered query beside its SQL on the same tables."""

import os

import pytest

import check
from larder.queries import CHECKS, QUERIES

from .conftest import TESTDATA

SF_DIR = f"{TESTDATA}/{os.environ.get('LARDER_TEST_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    outcome = check.compare(spark, duck, SF_DIR, name)
    assert not outcome.startswith("FAIL"), outcome


def test_only_approximate_answers_go_unchecked():
    assert set(QUERIES) - set(CHECKS) == {"distinct_approx", "profile_distinct"}
