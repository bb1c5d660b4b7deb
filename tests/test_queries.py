"""Every registered query of the library against its oracle; those without one must give rows."""

import pytest

from readloom.plans import ORACLES, QUERIES, flagship
from tests.oracle import same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_oracle(spark, sf_dir, name):
    same(spark, sf_dir, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).columns
    QUERIES[name](spark, sf_dir).count()


def test_flagship(spark, sf_dir):
    assert flagship(spark, sf_dir).count() > 0
