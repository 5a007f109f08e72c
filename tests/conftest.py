import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from collabstats.session import local_session

    s = local_session("*", shuffle_partitions=8, app="collabstats-tests")
    yield s
    s.stop()


USERS_DDL = "id bigint, login string, country_cleaned string, organization_cleaned string, sector string"
YEARLY_DDL = "branch string, author_id bigint, commit_year bigint"
FIRST_DDL = "author_id bigint, branch string, min_commit_year bigint"


def users_df(spark, rows):
    """rows: (id, country_cleaned, organization_cleaned, sector)"""
    return spark.createDataFrame([(i, f"u{i}", c, o, s) for i, c, o, s in rows], USERS_DDL)


def yearly_df(spark, rows):
    return spark.createDataFrame(rows, YEARLY_DDL)


def first_df(spark, rows):
    """rows: (branch, author_id, min_commit_year)"""
    return spark.createDataFrame([(a, b, y) for b, a, y in rows], FIRST_DDL)


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}
