"""The same comparison on tables with hot values and gaps.

A third of the pages share one address, a third of the documents one source, language
and text, a third of the events one user; some texts, sources, types and ids are missing, and
some ids are negative.
"""

import compare
import pytest

import __spark_entry__ as contract
from newspipe.plans.queries import REGISTRY

TABLES = {
    "pages": """select page_id, case when page_id % 3 = 0 then 'https://hot.example.org/a/b?c#d'
        else url end as url, case when page_id % 50 = 7 then null when page_id % 50 = 8 then ''
        else html end as html from pages where page_id < 120
        union all select 120 + page_id, 'https://hot.example.org/big',
        html || repeat(html, 20) from pages where page_id % 6 = 4 and page_id < 30""",
    "documents": """select doc_id, case when doc_id % 3 = 0 then 'same words' || chr(10) || 'again'
        when doc_id % 40 = 7 then null when doc_id % 40 = 8 then ''
        when doc_id % 40 = 10 then 'a "b" \\ c, d' || chr(10) || chr(10) || ' e'
        else text end as text,
        case when doc_id % 3 = 0 then 'en' else lang end as lang,
        case when doc_id % 3 = 0 then 'hot' when doc_id % 8 = 5 then null else source end as source,
        n_chars
        from documents where doc_id < 400""",
    "labels": "select * from labels",
    "events": """select case when event_id % 25 = 11 then null else event_id - 400 end as event_id, ts,
        case when event_id % 3 = 0 then 1 else user_id end as user_id,
        case when event_id % 10 = 4 then null else event_type end as event_type, value, case when event_id % 10 = 7 then null else props end as props
        from events where event_id < 900""",
}


@pytest.fixture(scope="module")
def skewed_dir(sf_dir, tmp_path_factory):
    path = tmp_path_factory.mktemp("skewed")
    duck = compare.connect(sf_dir)
    for name, sql in TABLES.items():
        duck.execute(f"copy ({sql}) to '{path}/{name}.parquet' (format parquet)")
    return str(path)


@pytest.fixture(scope="module")
def duck(skewed_dir):
    return compare.connect(skewed_dir)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, skewed_dir, duck, name):
    got = compare.spark_rows(contract.queries()[name](spark, skewed_dir))
    want = compare.sql_rows(duck, contract.oracle_sql()[name])
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]
