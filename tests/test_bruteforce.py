"""Spark reports vs a brute-force Python evaluation of the reference semantics,
on random fixtures with hot keys: one branch holds a third of the commit rows
and one author appears in a third of the branches."""

import random
from collections import defaultdict

import pytest

from collabstats.operators.collab import codeveloped_pairs, collaborations_by_country
from collabstats.operators.fractional import (
    fractional_repos_by_country,
    new_repos_by_country_year,
    new_repos_by_sector_year,
)
from tests.conftest import first_df, users_df, yearly_df

COUNTRIES = ["United States", "A", "B", "C", "D", ""]
SECTORS = ["academic", "business", "government", "nonprofit"]
YEARS = list(range(2009, 2024))


def make_fixture(seed):
    rnd = random.Random(seed)
    users = []
    for uid in range(1, 41):
        cs = rnd.sample(COUNTRIES, rnd.choice([1, 1, 2, 3]))
        cs = [c for c in cs if c] or [""]
        ss = rnd.sample(SECTORS, rnd.choice([0, 1, 1, 2]))
        users.append((uid, ", ".join(cs), "", ", ".join(ss)))
    users.append((3, "C", "", "business"))  # duplicate id with other values
    authors = list(range(1, 41)) + [900, 901, 902]   # some authors are unknown
    first = {}
    for k in range(240):
        branch = "hot" if k % 3 == 0 else f"b{rnd.randrange(60)}"
        author = 7 if k % 3 == 1 else rnd.choice(authors)
        year = rnd.choice([2009, 2010, 2011, 2014, 2014, 2015])
        key = (author, branch)
        first[key] = min(first.get(key, 9999), year)
    first_rows = [(b, a, y) for (a, b), y in first.items()]
    return users, first_rows


def expand(users, missing):
    out = defaultdict(set)
    for uid, cc, _org, _sec in users:
        for c in cc.split(","):
            c = c.strip()
            out[uid].add(c if c else missing)
    return out


def expand_cs(users):
    out = defaultdict(set)
    for uid, cc, _org, sec in users:
        for c in cc.split(","):
            c = c.strip() or "Missing"
            for s in sec.split(","):
                out[uid].add((c, s.strip() or "Unclassified"))
    return out


def brute_fractional(users, rows, year):
    ux = expand(users, "Missing Country")
    commits = [(b, a) for b, a, y in rows if y == year]
    branches = defaultdict(set)
    for b, a in commits:
        branches[b].add(a)
    out = defaultdict(float)
    for b, authors in branches.items():
        if not any(a in ux for a in authors):
            continue
        for a in authors:
            cs = ux.get(a, {"Missing Country"})
            for c in cs:
                out[c] += 1.0 / len(authors) / len(cs)
    return out


def brute_first_year(users, rows, by_sector):
    ux = expand_cs(users) if by_sector else {k: {(c, None) for c in v} for k, v in expand(users, "Missing").items()}
    per_branch = defaultdict(list)
    for b, a, y in rows:
        per_branch[b].append((a, y))
    cells = defaultdict(float)
    total = defaultdict(float)
    for b, items in per_branch.items():
        if not any(a in ux for a, _ in items):
            continue
        fy = min(y for _, y in items)
        authors = {a for a, y in items if y == fy}
        for a in authors:
            combos = ux.get(a, {("Missing", "Unclassified" if by_sector else None)})
            n_c = len({c for c, _ in combos})
            n_s = len({s for _, s in combos})
            total[fy] += 1.0 / len(authors)
            for c, s in combos:
                cells[(fy, c, s)] += 1.0 / len(authors) / (n_c * n_s)
    return cells, total


def r6(x):
    return round(x, 6)


@pytest.fixture(params=["plain", "salted"], autouse=True)
def salting(request, monkeypatch):
    """Run every comparison twice: default threshold (no key is hot) and with
    the hot-key threshold at 3 rows, so the hot author and most others take
    the salted join path."""
    from collabstats.operators import skew

    if request.param == "salted":
        monkeypatch.setattr(skew, "HOT_ROWS", 3)
    return request.param


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_fractional_by_country_bruteforce(spark, seed):
    users, first = make_fixture(seed)
    yearly = [(b, a, y) for b, a, y in first]   # reuse as one year's distinct commits
    got = {r.country: r.total_repositories
           for r in fractional_repos_by_country(yearly_df(spark, yearly), users_df(spark, users), 2014).collect()}
    want = brute_fractional(users, first, 2014)
    assert {k: r6(v) for k, v in got.items()} == {k: r6(v) for k, v in want.items()}


def _round_even(x):
    return float(round(round(x, 6)))  # Python's round is half-to-even


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_sectors_by_year_bruteforce(spark, seed):
    users, first = make_fixture(seed)
    got = {r.sector: r for r in new_repos_by_sector_year(first_df(spark, first), users_df(spark, users)).collect()}
    cells, total = brute_first_year(users, first, by_sector=True)
    want = defaultdict(lambda: defaultdict(float))
    for (y, c, s), v in cells.items():
        if c == "United States":
            want["Total (US)"][y] += v
            want[{"academic": "Academic", "government": "Government", "business": "Business",
                  "nonprofit": "Nonprofit"}.get(s, s)][y] += v
        elif c == "Missing":
            want["Total (Missing Country)"][y] += v
        else:
            want["Total (Global)"][y] += v
    for y, v in total.items():
        want["Total Repos"][y] += v
    assert set(got) == set(want)
    for label, per_year in want.items():
        for y in YEARS:
            assert got[label][str(y)] == _round_even(per_year.get(y, 0.0)), (label, y)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_countries_by_year_bruteforce(spark, seed):
    users, first = make_fixture(seed)
    got = {r.country: r for r in new_repos_by_country_year(first_df(spark, first), users_df(spark, users),
                                                           top_n=2).collect()}
    cells, total = brute_first_year(users, first, by_sector=False)
    overall = defaultdict(float)
    for (y, c, _), v in cells.items():
        if c != "Missing":
            overall[c] += v
    ranked = sorted(overall, key=lambda c: (-r6(overall[c]), c))
    top = [c for c in ranked if sum(1 for d in overall if r6(overall[d]) > r6(overall[c])) < 2]
    want = defaultdict(lambda: defaultdict(float))
    for (y, c, _), v in cells.items():
        if c == "Missing":
            want["Total (Missing Country)"][y] += v
        else:
            want["Total (Any Country)"][y] += v
            want[c if c in top else "All Other Countries"][y] += v
    for y, v in total.items():
        want["Total Repos"][y] += v
    assert set(got) == set(want)
    for label, per_year in want.items():
        for y in YEARS:
            assert got[label][str(y)] == _round_even(per_year.get(y, 0.0)), (label, y)
    order = [r.country for r in sorted(got.values(), key=lambda r: r.row_order)]
    assert order[:2] == ["Total Repos", "Total (Any Country)"] and order[2:2 + len(top)] == top


def brute_collab(users, rows, year):
    ux = expand(users, "Missing Country")
    branches = defaultdict(set)
    for b, a, y in rows:
        if y == year and a in ux:
            branches[b].add(a)
    out = defaultdict(lambda: [0, 0, 0])
    pairs = defaultdict(int)
    for b, authors in branches.items():
        countries = set().union(*(ux[a] for a in authors))
        foreign = {c for c in countries if c not in ("United States", "Missing Country")}
        has_us = "United States" in countries
        multi = len(authors) > 1
        for c in foreign:
            out[c][0] += has_us and multi
            out[c][1] += multi and len(foreign) > 1
            out[c][2] += (not has_us) and multi and len(foreign) > 1
        if multi:
            known = sorted(c for c in countries if c != "Missing Country")
            for i in range(len(known)):
                for j in range(i + 1, len(known)):
                    pairs[(known[i], known[j])] += 1
    return {c: tuple(v) for c, v in out.items() if sum(v) > 0}, dict(pairs)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_collab_and_pairs_bruteforce(spark, seed):
    users, first = make_fixture(seed)
    u, y = users_df(spark, users), yearly_df(spark, first)
    want_collab, want_pairs = brute_collab(users, first, 2014)
    got = {r.country: (r.collaborations_with_us, r.collaborations_with_non_us, r.collaborations_non_us_excl_us)
           for r in collaborations_by_country(y, u, 2014, top_n=None).collect()}
    assert got == want_collab
    got_pairs = {(r.country_1, r.country_2): r.co_developed_repositories for r in codeveloped_pairs(y, u, 2014).collect()}
    assert got_pairs == want_pairs


def test_salted_join_spreads_a_hot_key(spark):
    from collabstats.operators.skew import hot_keys, skewed_join

    large = spark.createDataFrame([(1, f"b{i}") for i in range(400)] + [(2, "x"), (3, "y")], "author_id long, branch string")
    small = spark.createDataFrame([(1, "A"), (1, "B"), (2, "C")], "author_id long, country string")
    out = skewed_join(large, small, "author_id", "left", ["branch"], hot_rows=50)   # 400 rows -> 8 salts
    rows = out.collect()
    assert len(rows) == 400 * 2 + 1 + 1            # every large row meets each of its key's small rows once
    assert sorted({r.country for r in rows if r.author_id == 1}) == ["A", "B"]
    assert [r.country for r in rows if r.author_id == 3] == [None]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    assert [tuple(r) for r in hot_keys(large, "author_id", 50).collect()] == [(1, 8)]   # ceil(400 / 50), without a ceiling
