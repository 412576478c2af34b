"""Every registered query against its SQL on the given tables."""

import compare
import pytest
from conftest import SF_DIR

import __spark_entry__ as contract
from newspipe.plans.queries import REGISTRY


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(REGISTRY) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, sf_dir, duck, name):
    got = compare.spark_rows(contract.queries()[name](spark, sf_dir))
    want = compare.sql_rows(duck, contract.oracle_sql()[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


def test_entry_gives_one_row_per_page_with_headline(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["url", "headline", "author", "publish_time", "article_content"]
    assert rows.count() == 42
