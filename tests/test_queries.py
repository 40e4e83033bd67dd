import pytest

from feedspark.plans import registry
from tests.oracle import same, views


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, sf, name):
    same(registry.QUERIES[name](spark, sf), views(sf).sql(registry.SQL[name]))


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_content_digest_ignores_order(spark):
    import hashlib

    from feedspark.operators.flatten import content_digest

    rows = [(1, "b"), (1, "aa"), (2, "aa"), (2, "b"), (3, "")]
    got = {r.p: r.digest for r in content_digest(spark.createDataFrame(rows, "p int, e string"), ["p"], "e").collect()}
    want = hashlib.sha256(b"".join(len(x).to_bytes(8, "big") + x for x in (b"aa", b"b"))).hexdigest()
    assert got[1] == got[2] == want and got[3] != want
