"""Every registered query against its SQL check on the smallest tables."""

import pytest
from compare import compare, connect
from conftest import SMALL
from lakeprofile.plans import match_metrics
from lakeprofile.registry.core import Inputs

from __spark_entry__ import oracle_sql, queries


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="module")
def sqls():
    return oracle_sql()


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, sqls, name):
    df = queries()[name](spark, SMALL)
    if name in sqls:
        ok, note = compare(name, df, duck, sqls[name])
        assert ok, note
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", ["startup_profiles_b", "company_analytics"])
def test_one_row_per_company(spark, name):
    """The bound crawls and health checks hold older rows of the same keys."""
    ids = [r.company_id for r in queries()[name](spark, SMALL).select("company_id").collect()]
    assert len(ids) == len(set(ids)) > 0


def test_means_do_not_depend_on_the_order_of_rows(spark):
    rows = Inputs(spark, SMALL)["b_shortlists"]
    shown = ["dt", "challenge_id", "ams_challenge", "avg_embedding_similarity", "avg_ml_score"]
    one, many = (match_metrics.challenge_metrics(df).select(*shown).collect() for df in (rows.coalesce(1), rows.repartition(17)))
    assert sorted(map(tuple, one)) == sorted(map(tuple, many))
