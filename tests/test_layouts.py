"""Hot authors set apart in bucketed layouts, and years added one by one."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from collabstats.operators import skew
from collabstats.operators.credit import credit_cells
from collabstats.operators.expand import expand_countries
from collabstats.plans.incremental import add_year, first_from
from collabstats.plans.jobs import Prepared, RawInputs, prepare_primary, prepare_secondary, report_builders
from collabstats.schemas import RAW_COMMITS_SCHEMA, RAW_USERS_SCHEMA
from collabstats.sources import adapter
from tests.conftest import SF001, users_df


def _folder():
    return tempfile.mkdtemp(prefix="collabstats-test-")


@pytest.fixture(scope="module")
def users(spark):
    names = RAW_USERS_SCHEMA.fieldNames()
    rows = [{**dict.fromkeys(names), "id": i, "login": f"u{i}", "country_location": ["A", "B|C", "United States", None][i % 4], "nonprofit": i % 2,
             "government": 0, "business": 1, "academic": 0} for i in range(1, 40)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], RAW_USERS_SCHEMA)


def _commits(spark, seed=1, rows=900, years=range(2009, 2014)):
    """A third of the rows is one author's; some branches and author ids are NULL."""
    rng = random.Random(seed)
    out = []
    for n in range(rows):
        year = rng.choice(list(years))
        author = 7 if n % 3 == 0 else rng.randrange(1, 60)
        branch = None if n % 50 == 0 else f"b{rng.randrange(120)}"
        out.append((branch, [author, None] if n % 10 == 0 else [author], f"{year}-06-01 00:00:00"))
    table = spark.createDataFrame(out, "branch string, authors_id array<bigint>, at string")
    return table.select("branch", "authors_id", F.to_timestamp_ntz("at").alias("committedat")).to(RAW_COMMITS_SCHEMA)


def _rows(df):
    return sorted(map(str, df.collect()))


STATE = ("commits_yearly", "commits_first", "branch_years")


def _state(spark, prepared):
    return {t: _rows(prepared.read(spark, t).drop(skew.HOT)) for t in STATE}


@pytest.mark.parametrize("buckets", [None, 3])
def test_years_added_one_by_one_equal_a_full_run(spark, users, buckets):
    raw, years = _commits(spark), list(range(2009, 2014))
    of = lambda *ys: raw.where(F.year("committedat").isin(*ys))
    full = prepare_primary(spark, RawInputs(users, raw), _folder(), years, incremental=True)
    want = _state(spark, full)
    state = prepare_primary(spark, RawInputs(users, of(2009, 2011)), Prepared(_folder(), buckets), years, hot_rows=50, incremental=True)
    for year in (2012, 2013, 2010):        # two that come last, and one between
        state = add_year(spark, state, of(year), year, hot_rows=50)
    assert _state(spark, state) == want
    if buckets:
        assert state.read(spark, "hot_authors").count() > 0
        assert state.read(spark, "commits_first").where(skew.HOT).count() > 50
    # a year that changes, then comes back; one that empties
    other = _commits(spark, seed=2, years=[2010])
    changed = add_year(spark, state, other, 2010)
    again = prepare_primary(spark, RawInputs(users, of(2009, 2011, 2012, 2013).unionByName(other)), _folder(), years, incremental=True)
    assert _state(spark, changed) == _state(spark, again)
    assert _state(spark, add_year(spark, changed, of(2010), 2010)) == want
    emptied = add_year(spark, changed, raw.where(F.lit(False)), 2012)
    less = prepare_primary(spark, RawInputs(users, of(2009, 2010, 2011, 2013)), _folder(), years, incremental=True)
    assert _state(spark, emptied) == _state(spark, less)


def test_adding_the_last_year_writes_only_its_folders(spark, users):
    import os

    raw = _commits(spark)
    of = lambda *ys: raw.where(F.year("committedat").isin(*ys))
    state = prepare_primary(spark, RawInputs(users, of(2009, 2010, 2011, 2012)), _folder(), list(range(2009, 2014)), incremental=True)
    names = lambda: {os.path.relpath(os.path.join(d, f), state.root) for t in STATE for d, _, fs in os.walk(state.path(t))
                     for f in fs if f.endswith(".parquet")}
    before = names()
    add_year(spark, state, of(2013), 2013)
    assert before < names() and all("year=2013" in f for f in names() - before)
    with pytest.raises(ValueError, match="incremental=True"):
        add_year(spark, prepare_primary(spark, RawInputs(users, of(2009)), _folder()), of(2010), 2010)


def test_earlier_pairs_are_not_shuffled_in_buckets(spark, users):
    from collabstats.plans.incremental import CO_LOCATED
    from collabstats.session import settings

    state = prepare_primary(spark, RawInputs(users, _commits(spark)), Prepared(_folder(), 3), list(range(2009, 2014)), hot_rows=50, incremental=True)
    with settings(spark, {**CO_LOCATED, "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}):
        plan = first_from(state, spark, 2013)._jdf.queryExecution().executedPlan().toString().splitlines()
    earlier = [i for i, line in enumerate(plan) if "FileScan" in line and "_commits_first[" in line]
    assert earlier
    for i in earlier:
        depth = plan[i].index("FileScan")
        above, at = [], depth
        for line in reversed(plan[:i]):      # the operators above the scan, up to its join
            here = len(line) - len(line.lstrip(" :+-*()0123456789"))
            if here < at:
                above.append(line)
                at = here
            if "SortMergeJoin" in line:
                break
        assert any("SortMergeJoin" in line for line in above) and not any("Exchange" in line for line in above), above


def _cells(commits, users, **how):
    cells = credit_cells(commits, expand_countries(users, "Missing"), ["country"], ["Missing"], commits_distinct=True, **how)
    return sorted(map(str, cells.withColumn("credit", F.round("credit", 9)).collect()))


def test_split_join_equals_a_plain_join(spark):
    people = users_df(spark, [(i, ["A, B", "C", "", "United States"][i % 4], "", "") for i in range(30)] + [(7, "D", "", "")])
    commits = spark.createDataFrame([(f"b{n % 40}", 7 if n < 40 else n % 45) for n in range(40, 400)] + [(f"b{n}", 7) for n in range(40)] + [("b1", 1000)],
                                    "branch string, author_id bigint").distinct()
    hot = skew.hot_keys(commits, "author_id", 15)
    assert 0 < hot.count() < 45
    marked = skew.mark_hot(commits, "author_id", hot)
    assert marked.where(skew.HOT).select("author_id").distinct().count() == hot.count()
    assert _cells(marked, people, hot_rows=hot) == _cells(commits, people, hot_rows=0)
    # an empty hot set, and one that holds every author
    none, every = hot.where("false"), skew.hot_keys(commits, "author_id", 1)
    for some in (none, every):
        assert _cells(skew.mark_hot(commits, "author_id", some), people, hot_rows=some) == _cells(commits, people, hot_rows=0)


def test_hot_set_is_bounded_in_bytes(spark):
    hot = spark.createDataFrame([(1, 9), (2, 8), (3, 7), (4, 6)], "author_id bigint, salts int")
    sizes = spark.createDataFrame([(1, 60), (2, 30), (2, 15), (3, 50), (9, 10 ** 9)], "author_id bigint, bytes bigint")
    held = lambda limit: sorted(r.author_id for r in skew.within_bytes(hot, sizes, "author_id", limit).collect())
    assert held(200) == [1, 2, 3, 4] and held(120) == [1, 2] and held(59) == [] and held(0) == []


def test_bucketed_reports_with_hot_authors(spark):
    """Every report over a layout with hot authors equals the plain one; the cold join shuffles neither side."""
    raw = RawInputs(adapter.raw_users(spark, SF001), adapter.raw_commits(spark, SF001),
                    adapter.raw_users_secondary(spark, SF001), adapter.raw_commits_secondary(spark, SF001))
    plain = prepare_secondary(spark, raw, prepare_primary(spark, raw, _folder()))
    split = prepare_secondary(spark, raw, prepare_primary(spark, raw, Prepared(_folder(), buckets=4), hot_rows=40), hot_rows=40)
    assert split.read(spark, "hot_authors").count() > 0 and split.read(spark, "commits_merged").where(skew.HOT).count() > 0
    a, b = report_builders(spark, plain, 2014), report_builders(spark, split, 2014)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in a:
            x, y = a[name](), b[name]()
            assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, name
            plan = y._jdf.queryExecution().executedPlan().toString().splitlines()
            j = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line)
            cold = plan[j + 1:next(i for i in range(j + 1, len(plan) + 1) if i == len(plan) or "BroadcastHashJoin" in plan[i])]
            assert not any("Exchange hashpartitioning" in line for line in cold), name
            assert "BroadcastHashJoin" in "".join(plan), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    for t in ("commits_yearly", "commits_first", "commits_merged"):     # a session without the catalog entries reads the same rows
        spark.sql(f"DROP TABLE {split.table(t)}")
        assert split.read(spark, t).exceptAll(plain.read(spark, t)).count() == 0 and split.read(spark, t).count() == plain.read(spark, t).count()
