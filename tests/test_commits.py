import datetime as dt

from collabstats.operators.commits import (
    commit_rows,
    first_commits,
    first_commits_secondary,
    yearly_commits,
)
from collabstats.operators.merge import merge_commits, merge_users
from collabstats.schemas import RAW_COMMITS_SCHEMA, RAW_COMMITS_SECONDARY_SCHEMA
from tests.conftest import first_df, users_df


def ts(y, m=6, d=1):
    return dt.datetime(y, m, d)


def test_yearly_commits_explodes_and_dedupes(spark):
    raw = spark.createDataFrame([
        ("b1", [1, 2], ts(2010)),
        ("b1", [1], ts(2010, 7)),       # duplicate (b1, 1, 2010)
        ("b1", [], ts(2011)),           # empty list: no row
        ("b2", None, ts(2011)),         # NULL list: no row
        ("b2", [3, None], ts(2011)),    # NULL author dropped (T8)
        ("b3", [4], ts(2008, 12, 31)),  # before the first year: clipped
        ("b3", [4], ts(2024, 1, 1)),    # after the last year
    ], RAW_COMMITS_SCHEMA)
    got = sorted(tuple(r) for r in yearly_commits(raw).collect())
    assert got == [("b1", 1, 2010), ("b1", 2, 2010), ("b2", 3, 2011)]


def test_first_commits_min_year_and_clipping(spark):
    raw = spark.createDataFrame([
        ("b1", [1], ts(2012)), ("b1", [1], ts(2010)), ("b1", [2], ts(2008)), ("b1", [2], ts(2015)),
    ], RAW_COMMITS_SCHEMA)
    got = sorted(tuple(r) for r in first_commits(commit_rows(raw)).collect())
    # author 2 started in 2008, which is clipped: 2015 is its first visible year
    assert got == [(1, "b1", 2010), (2, "b1", 2015)]
    assert sorted(tuple(r) for r in first_commits(yearly_commits(raw)).collect()) == got


def test_secondary_first_commits_remove_early_pairs(spark):
    raw = spark.createDataFrame([
        (1, "b1", ts(2008)), (1, "b1", ts(2012)),   # started before 2009: removed entirely
        (2, "b1", ts(2010)), (2, "b1", ts(2030)),   # no upper bound
        (3, "b2", ts(2031)),
    ], RAW_COMMITS_SECONDARY_SCHEMA)
    got = sorted(tuple(r) for r in first_commits_secondary(raw).collect())
    assert got == [(2, "b1", 2010), (3, "b2", 2031)]


def test_merge_users_first_source_wins_and_null_ids_drop(spark):
    a = users_df(spark, [(1, "A", "", ""), (2, "B", "", "")])
    b = users_df(spark, [(2, "Z", "", ""), (3, "C", "", ""), (None, "N", "", "")])
    got = sorted((r.id, r.country_cleaned) for r in merge_users(a, b).collect())
    assert got == [(1, "A"), (2, "B"), (3, "C")]


def test_merge_commits_anti_join_on_two_keys(spark):
    a = first_df(spark, [("b1", 1, 2010), ("b2", 1, 2011)])
    b = first_df(spark, [("b1", 1, 2009), ("b1", 2, 2012), ("b3", None, 2013)])
    got = sorted(merge_commits(a, b).collect(), key=lambda r: (r.branch, r.author_id or -1))
    got = [(r.branch, r.author_id, r.min_commit_year) for r in got]
    # (1, b1) exists in the first source, so its 2010 wins; NULL keys are kept (NOT EXISTS)
    assert got == [("b1", 1, 2010), ("b1", 2, 2012), ("b2", 1, 2011), ("b3", None, 2013)]


def test_year_bits_give_the_same_tables(spark):
    from collabstats.operators.commits import commit_years, first_year, years_to_rows
    from collabstats.sources import adapter
    from tests.conftest import SF001

    raw = adapter.raw_commits(spark, SF001)
    bits = commit_years(raw)
    assert years_to_rows(bits).exceptAll(yearly_commits(raw)).count() == 0
    assert yearly_commits(raw).exceptAll(years_to_rows(bits)).count() == 0
    assert first_year(bits).exceptAll(first_commits(commit_rows(raw))).count() == 0
    assert first_commits(commit_rows(raw)).exceptAll(first_year(bits)).count() == 0
    edge = spark.createDataFrame([("b", [1], ts(2009)), ("b", [1], ts(2023)), ("c", [2], ts(2023))], RAW_COMMITS_SCHEMA)
    assert sorted(tuple(r) for r in first_year(commit_years(edge)).collect()) == [(1, "b", 2009), (2, "c", 2023)]
    assert sorted(tuple(r) for r in years_to_rows(commit_years(edge)).collect()) == \
        [("b", 1, 2009), ("b", 1, 2023), ("c", 2, 2023)]
