"""Each catalogue query next to its checking SQL, over whole tables at the smallest scale."""

import warnings

import pytest

import __spark_entry__ as entry_point
from compare import differences, engine

SF_DIR = "/root/testdata/sf0.001"
# the checks of the wide reports name the day columns of the larger scales
FULL_MONTH = {"package_report_wide": "/root/testdata/sf0.01", "artifact_report_wide": "/root/testdata/sf0.01"}
QUERIES, CHECKS = entry_point.queries(), entry_point.oracle_sql()


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(CHECKS)))
def test_query_equals_its_check(spark, name):
    warnings.simplefilter("ignore")
    sf_dir = FULL_MONTH.get(name, SF_DIR)
    assert differences(QUERIES[name], CHECKS[name], spark, engine(sf_dir), sf_dir) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_query_without_check_returns_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


def test_flagship(spark):
    result = entry_point.entry(spark)
    assert result.columns[:2] == ["package_uuid", "total_downloads"] and result.count() > 0
