import os

import pytest

import __spark_entry__ as registered

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_every_sql_belongs_to_a_query():
    assert set(registered.oracle_sql()) <= set(registered.queries())


def test_flagship(spark):
    assert registered.entry(spark).count() == 98
