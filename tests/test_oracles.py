"""Each registered query against the same result in SQL on a second engine."""

import functools
import os

import pytest

from checks import queries as registered
from checks.compare import connect, difference
from checks.oracles import oracle_sql
from checks.queries import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module", autouse=True)
def one_run_of_each_job():
    """Here, but not in the queries themselves, one run of a job serves all that read it."""
    with pytest.MonkeyPatch.context() as patch:
        for name in ("job_root", "lean_job_root"):
            patch.setattr(registered, name, functools.cache(getattr(registered, name)))
        yield


@pytest.fixture(scope="module")
def engine():
    with connect(SF) as con:
        yield con


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_same_rows(spark, engine, name):
    assert difference(spark, engine, name, SF) == ""


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_runs(spark, name):
    assert queries()[name](spark, SF).count() > 0
