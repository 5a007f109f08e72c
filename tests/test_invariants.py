
import pytest
from pyspark.sql import functions as F

from collabstats import tables as T
from collabstats.operators.credit import credit_cells
from collabstats.operators.expand import expand_countries
from collabstats.operators.fractional import fractional_repos_by_country, new_repos_by_country_year, new_repos_by_sector_year
from collabstats.operators.institutions import new_repos_by_agency_year, repos_by_agency
from tests.conftest import SF01

YEARS = [str(y) for y in range(2009, 2024)]


@pytest.fixture(scope="module")
def base(spark):
    users = T.users(spark, SF01).cache()
    yearly = T.commits_yearly(spark, SF01).cache()
    first = T.commits_first(spark, SF01).cache()
    return users, yearly, first


def test_fractional_total_equals_kept_branches(spark, base):
    users, yearly, _ = base
    total = fractional_repos_by_country(yearly, users, T.PRODUCTION_YEAR).agg(F.sum("total_repositories")).first()[0]
    ids = users.select(F.col("id").alias("author_id"))
    kept = yearly.where(F.col("commit_year") == T.PRODUCTION_YEAR).join(ids, "author_id", "left_semi") \
        .select("branch").distinct().count()
    assert total == pytest.approx(kept, abs=1e-6)
    assert kept == 7585   # FIXTURES.md §2


def test_branch_credit_sums_to_one(spark, base):
    users, _, first = base
    cells = credit_cells(first.select("branch", "author_id", F.col("min_commit_year").alias("year")),
                         expand_countries(users, "Missing", "country_val"), ["country_val"], ["Missing"], "year")
    per_branch = cells.where(~F.col("is_total")).groupBy("branch").agg(F.sum("credit").alias("s"))
    assert per_branch.where(F.abs(F.col("s") - 1) > 1e-9).count() == 0


def test_sector_rows_add_up(spark, base):
    users, _, first = base
    raw = {r.sector: r for r in new_repos_by_sector_year(first, users).collect()}
    assert raw["Total Repos"]["2009"] == 7377   # FIXTURES.md §2
    for y in YEARS:
        parts = raw["Total (Global)"][y] + raw["Total (US)"][y] + raw["Total (Missing Country)"][y]
        assert abs(parts - raw["Total Repos"][y]) <= 2      # each term rounded separately
        sectors = sum(raw[s][y] for s in ("Academic", "Government", "Business", "Nonprofit", "Unclassified") if s in raw)
        assert abs(sectors - raw["Total (US)"][y]) <= 3


def test_country_rows_add_up(spark, base):
    users, _, first = base
    rows = {r.country: r for r in new_repos_by_country_year(first, users).collect()}
    specials = {"Total Repos", "Total (Any Country)", "All Other Countries", "Total (Missing Country)"}
    top = [c for c in rows if c not in specials]
    assert len(top) >= 10
    for y in YEARS:
        assert abs(rows["Total (Any Country)"][y] + rows["Total (Missing Country)"][y] - rows["Total Repos"][y]) <= 1
        parts = sum(rows[c][y] for c in top) + rows.get("All Other Countries", {y: 0})[y]
        assert abs(parts - rows["Total (Any Country)"][y]) <= len(top) + 1


def test_agency_year_rows_sum_to_totals(spark):
    users, commits = T.users_merged(spark, SF01), T.commits_merged(spark, SF01)
    totals = {r.institution: r.n_repositories for r in repos_by_agency(commits, users).collect()}
    wide = new_repos_by_agency_year(commits, users)
    years = [c for c in wide.columns if c.isdigit()]
    assert years == [str(y) for y in range(2009, 2026)]   # the report years and the later ones that occur
    rows = wide.collect()
    for r in rows:
        assert sum(r[y] for y in years) == totals[r.institution]
    assert sum(r["2024"] + r["2025"] for r in rows) > 0
    listed = sum(v for k, v in totals.items() if k not in ("Federal Total", "All Other Federal"))
    assert totals["Federal Total"] >= listed + totals["All Other Federal"]


def test_agency_years_outside_an_explicit_list_fail(spark):
    users, commits = T.users_merged(spark, SF01), T.commits_merged(spark, SF01)
    with pytest.raises(Exception, match="outside the report"):
        new_repos_by_agency_year(commits, users, years=list(range(2009, 2024))).collect()


def test_repeated_commit_rows_do_not_count(spark):
    """Authors are counted once however often a commit row occurs."""
    users = spark.createDataFrame([(1, "a", "A, B", "", ""), (2, "b", "US", "", "")], "id bigint, login string, country_cleaned string, organization_cleaned string, sector string")
    once = spark.createDataFrame([("r", 1, 2014), ("r", 2, 2014)], "branch string, author_id bigint, commit_year bigint")
    often = once.unionByName(once.where("author_id = 1")).unionByName(once.where("author_id = 1"))
    a, b = (fractional_repos_by_country(c, users, 2014).collect() for c in (once, often))
    assert a == b and {r.country: r.total_repositories for r in a} == {"A": 0.25, "B": 0.25, "US": 0.5}
    single = spark.createDataFrame([("r", 1, 2014), ("r", 1, 2014)], once.schema)
    from collabstats.operators.collab import codeveloped_pairs, collaborations_by_country
    assert collaborations_by_country(single, users, 2014).count() == 0 and codeveloped_pairs(single, users, 2014).count() == 0
    first = often.selectExpr("author_id", "branch", "commit_year as min_commit_year")
    distinct = first.distinct()
    for report in (new_repos_by_sector_year, new_repos_by_country_year):
        assert sorted(map(str, report(first, users).collect())) == sorted(map(str, report(distinct, users, commits_distinct=True).collect()))


def test_merged_tables_have_unique_keys(spark):
    users = T.users_merged(spark, SF01)
    assert users.count() == users.select("id").distinct().count()
    commits = T.commits_merged(spark, SF01)
    assert commits.count() == commits.select("author_id", "branch").distinct().count()


def test_fixture_figures_for_the_second_source(spark):
    """FIXTURES.md §2: 25 of 100 second-source ids occur in the first source; every agency rule is met."""
    from collabstats.schemas import AGENCY_RULES
    from collabstats.sources import adapter

    first, first2 = T.commits_first(spark, SF01), T.commits_first_secondary(spark, SF01)
    overlap = first2.join(first.select("author_id", "branch"), ["author_id", "branch"], "left_semi").count()
    assert overlap > 0
    assert T.commits_merged(spark, SF01).count() == first.count() + first2.count() - overlap
    raw2 = adapter.raw_users_secondary(spark, SF01)
    assert raw2.join(T.users(spark, SF01).select("id"), "id", "left_semi").count() == 25
    met = {r.new_agencies for r in T.agency_classes(spark, SF01).select("new_agencies").distinct().collect()}
    assert {label for label, _, _ in AGENCY_RULES} | {None} == met
