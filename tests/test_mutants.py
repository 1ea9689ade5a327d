"""Each semantic trap's wrong variant gives a different result on the fixture; ours equals the right one."""

import pytest

import comptoir_oracle as oracle
from comptoir.api import QUERIES
from helpers import duck, duck_rows, spark_rows
from mutants import MUTANTS

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("mutant", sorted(MUTANTS))
def test_mutant_is_detected(spark, con, mutant):
    key, old, new = MUTANTS[mutant]
    right = oracle.sql(key)
    assert old in right, "mutant edit must apply"
    wrong = right.replace(old, new, 1)
    ours = QUERIES[key](spark, SF)
    cols = sorted(ours.columns)
    got = spark_rows(ours, cols)
    assert got == duck_rows(con, right, cols)
    assert got != duck_rows(con, wrong, cols), mutant
