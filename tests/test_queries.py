"""Every registered query against its SQL twin on the smallest tables."""

import compare
import pytest

import __spark_entry__ as entry_points

ORACLE = entry_points.oracle_sql()
QUERIES = {name: query for name, query in entry_points.queries().items() if name in ORACLE}


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sf_dir, con, name):
    ours = QUERIES[name](spark, sf_dir).toPandas()
    theirs = con.execute(ORACLE[name]).df()
    assert len(ours) > 0
    assert compare.differences(ours, theirs) == ""


def test_entry_has_the_ten_columns(spark):
    assert entry_points.entry(spark).columns == [
        "commentid", "nature", "content", "words", "class", "devicecode", "brandcode", "storename", "storeid",
        "createtime",
    ]
