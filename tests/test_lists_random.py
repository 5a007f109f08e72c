"""Randomised check of the list semantics against small Python models."""

import random

from collabstats.operators.clean import clean_users
from collabstats.operators.expand import expand_aligned, expand_country_sector
from collabstats.schemas import COUNTRY_COLUMNS, ORG_COLUMNS_PRIMARY, RAW_USERS_SCHEMA, SECTOR_FLAGS
from tests.conftest import USERS_DDL

WORDS = ["A", "B", "C", "Acme, Inc.", "Inc. Co", "X|Y", "Y", ""]


def model_clean(row):
    def merged(cols):
        parts = [row[c].replace("|", ", ") for c in cols if row[c] is not None]
        out = []
        for x in ", ".join(parts).split(", "):
            if x not in out:
                out.append(x)
        return ", ".join(out)
    sector = ", ".join(f for f in SECTOR_FLAGS if row[f] == 1)
    return merged(COUNTRY_COLUMNS), merged(ORG_COLUMNS_PRIMARY).replace("Inc.", ""), sector


def test_clean_users_matches_model(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(300):
        r = {f.name: None for f in RAW_USERS_SCHEMA.fields}
        r.update(id=i, login=f"l{i}")
        for c in COUNTRY_COLUMNS + ORG_COLUMNS_PRIMARY:
            if rnd.random() < 0.5:
                r[c] = "|".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 3)))
        for f in SECTOR_FLAGS:
            r[f] = rnd.randint(0, 1)
        rows.append(r)
    got = {r.id: (r.country_cleaned, r.organization_cleaned, r.sector)
           for r in clean_users(spark.createDataFrame(rows, RAW_USERS_SCHEMA)).collect()}
    assert got == {r["id"]: model_clean(r) for r in rows}


def test_expansions_match_model(spark):
    rnd = random.Random(11)
    users = []
    for i in range(300):
        lists = [", ".join(rnd.choice(["A", "B", " C", ""]) for _ in range(rnd.randint(1, 3))) for _ in range(3)]
        users.append((i, f"u{i}", lists[0], None if rnd.random() < 0.1 else lists[1], lists[2]))
    df = spark.createDataFrame(users, USERS_DDL)

    def split(s):
        return [] if s is None else [x.strip() for x in s.split(",")]

    want_zip, want_cross = [], []
    for i, _l, cc, oc, sc in users:
        c, o, s = split(cc), split(oc), split(sc)
        n = max(len(c), len(o), len(s))
        pad = lambda xs: xs + [None] * (n - len(xs))
        want_zip += [(i, a, b, d) for a, b, d in zip(pad(o), pad(c), pad(s))]
        want_cross += [(i, x or "Missing", y or "Unclassified") for x in c for y in s]
    key = lambda t: tuple("" if v is None else str(v) for v in t)
    got_zip = sorted(((r.id, r.org, r.country, r.sector) for r in expand_aligned(df).collect()), key=key)
    assert got_zip == sorted(want_zip, key=key)
    got_cross = sorted((tuple(r) for r in expand_country_sector(df).collect()), key=key)
    assert got_cross == sorted(want_cross, key=key)
