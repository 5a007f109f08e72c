from collabstats.operators.expand import expand_aligned, expand_countries, expand_country_sector
from tests.conftest import USERS_DDL, users_df


def test_expand_countries_labels_blank(spark):
    u = users_df(spark, [(1, "", "", ""), (2, "A, B", "", ""), (3, "A,", "", "")])
    got = sorted(tuple(r) for r in expand_countries(u).collect())
    assert got == [(1, "Missing Country"), (2, "A"), (2, "B"), (3, "A"), (3, "Missing Country")]


def test_expand_aligned_pads_with_null(spark):
    u = spark.createDataFrame([
        (1, "u1", "C1, C2, C3", "O1", "s1, s2"),
        (2, "u2", "C1", None, "s1"),        # NULL list: row kept (T3)
    ], USERS_DDL)
    got = sorted(((r.id, r.org, r.country, r.sector) for r in expand_aligned(u).collect()),
                 key=lambda t: tuple("" if v is None else str(v) for v in t))
    assert got == [(1, None, "C2", "s2"), (1, None, "C3", None), (1, "O1", "C1", "s1"), (2, None, "C1", "s1")]


def test_expand_country_sector_is_cross_product(spark):
    u = users_df(spark, [(1, "A, B", "", "x, y"), (2, "", "", "")])
    got = sorted(tuple(r) for r in expand_country_sector(u).collect())
    assert got == [(1, "A", "x"), (1, "A", "y"), (1, "B", "x"), (1, "B", "y"), (2, "Missing", "Unclassified")]


def test_missing_columns_are_reported(spark):
    import pytest

    from collabstats.sources.parquet import MissingColumnsError

    with pytest.raises(MissingColumnsError, match="country_cleaned"):
        expand_countries(spark.createDataFrame([(1, "x")], "id bigint, country string"))
