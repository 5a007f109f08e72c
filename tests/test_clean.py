from pyspark.sql import functions as F

from collabstats.operators.clean import attach_agency, classify_agency, clean_users
from collabstats.schemas import RAW_USERS_SCHEMA, RAW_USERS_SECONDARY_SCHEMA, ORG_COLUMNS_SECONDARY


def _raw(spark, schema, **cols):
    row = {f.name: None for f in schema.fields}
    row.update({"nonprofit": 0, "government": 0, "business": 0, "academic": 0})
    row.update(cols)
    return row


def _clean_one(spark, **cols):
    df = spark.createDataFrame([_raw(spark, RAW_USERS_SCHEMA, id=1, login="a", **cols)], RAW_USERS_SCHEMA)
    return clean_users(df).collect()[0]


def test_all_null_lists_give_empty_string(spark):
    r = _clean_one(spark)
    assert (r.country_cleaned, r.organization_cleaned, r.sector) == ("", "", "")


def test_dedupe_keeps_first_seen_order(spark):
    r = _clean_one(spark, country_location="A|B", country_email="B", country_government="C|A")
    assert r.country_cleaned == "A, B, C"


def test_inc_removed_after_join_splits_later(spark):
    # `Google, Inc.` -> "Google, " once `Inc.` is removed (trap T2)
    r = _clean_one(spark, organization_company_business="Google, Inc.")
    assert r.organization_cleaned == "Google, "
    assert [s.strip() for s in r.organization_cleaned.split(",")] == ["Google", ""]


def test_new_agencies_is_last_org(spark):
    r = _clean_one(spark, organization_company_government="USDA Forest", new_agencies="Department of Agriculture")
    assert r.organization_cleaned == "USDA Forest, Department of Agriculture"


def test_sector_order_is_fixed(spark):
    r = _clean_one(spark, academic=1, business=1, nonprofit=1)
    assert r.sector == "nonprofit, business, academic"


def _classify(spark, rows):
    data = [_raw(spark, RAW_USERS_SECONDARY_SCHEMA, id=i, login=f"l{i}", organization_company_government=org,
                 country_government=country, government=1) for i, (org, country) in enumerate(rows)]
    df = spark.createDataFrame(data, RAW_USERS_SECONDARY_SCHEMA)
    return {r.login: (r.new_agencies, r.org_in_agency) for r in classify_agency(df).collect()}


def test_rule_order_and_case(spark):
    got = _classify(spark, [
        ("Department of Labor", "United States"),          # 0: word-boundary rule (T6 decision)
        ("Argonne National Laboratory", "United States"),  # 1: Energy (Laboratory)
        ("bureau of labor statistics", "United States"),   # 2: Labor, ignore case
        ("national aeronautics and space administration", "United States"),  # 3: case-sensitive -> none
        ("NASA Goddard", "United States"),                  # 4: no rule
        ("USDA Energy", "United States"),                   # 5: first rule wins
        ("FEMA", "United States"),                          # 6: Homeland Security
        ("GSA", "United States"),                           # 7
    ])
    assert got["l0"] == ("Department of Labor", True)
    assert got["l1"] == ("Department of Energy", True)
    assert got["l2"] == ("Department of Labor", True)
    assert got["l3"] == (None, False)
    assert got["l4"] == (None, False)
    assert got["l5"] == ("Department of Agriculture", True)
    assert got["l6"] == ("Department of Homeland Security", True)
    assert got["l7"] == ("General Services Administration", True)


#: An organisation of each agency, and whether its rule reads over the case of letters (stated here by hand, not taken from the rules).
EACH_AGENCY = [
    ("Department of Agriculture", "USDA Forest Service", True),
    ("Department of Commerce", "US Patent and Trademark Office", True),
    ("Department of the Interior", "National Park Service", True),
    ("Department of Defense", "Department of Defense", True),
    ("Department of Energy", "Oak Ridge", True),
    ("Department of Health and Human Services", "National Institutes of Health", False),
    ("Department of Homeland Security", "USCIS", False),
    ("Department of Justice", "Unicor", True),
    ("Department of Labor", "Bureau of Labor Statistics", True),
    ("Department of Transportation", "NHTSA", False),
    ("Department of Veterans Affairs", "Department of Veterans Affairs", True),
    ("Environmental Protection Agency", "US Environmental Protection Agency", True),
    ("Federal Election Commission", "Federal Election Commission", True),
    ("General Services Administration", "General Services Administration", False),
    ("National Aeronautics and Space Administration", "National Aeronautics and Space Administration", False),
    ("National Science Foundation", "US National Science Foundation", False),
    ("Office of Personnel Management", "OPM", False),
    ("Social Security Administration", "Social Security Administration", False),
    ("Department of State", "US Department of State", False),
]


def test_every_agency_has_its_rule(spark):
    got = _classify(spark, [(org.swapcase() if swap else org, "United States") for swap in (False, True) for _, org, _ in EACH_AGENCY])
    for i, (agency, _, any_case) in enumerate(EACH_AGENCY):
        assert got[f"l{i}"] == (agency, True)
        assert got[f"l{len(EACH_AGENCY) + i}"] == ((agency, True) if any_case else (None, False)), agency


def test_country_filter_and_binds_first(spark):
    got = _classify(spark, [
        (None, "United States of America"),   # kept without org (P17), no agency
        (None, "United States"),              # dropped: needs an org
        ("GSA", "Canada"),                    # dropped
        ("GSA", None),                        # dropped (NULL comparison)
    ])
    assert got == {"l0": (None, False)}


def test_attach_agency_left_join_on_login(spark):
    data = [
        _raw(spark, RAW_USERS_SECONDARY_SCHEMA, id=1, login="a", organization_company_government="GSA",
             country_government="United States", government=1),
        _raw(spark, RAW_USERS_SECONDARY_SCHEMA, id=2, login="b", government=1),
        _raw(spark, RAW_USERS_SECONDARY_SCHEMA, id=3, login="c", organization_company_government="GSA",
             country_government="United States", government=0),
    ]
    df = spark.createDataFrame(data, RAW_USERS_SECONDARY_SCHEMA)
    out = {r.id: (r.new_agencies, r.org_in_agency) for r in attach_agency(df, classify_agency(df)).collect()}
    assert out == {1: ("General Services Administration", True), 2: (None, None)}
    cleaned = clean_users(attach_agency(df, classify_agency(df)), ORG_COLUMNS_SECONDARY)
    assert cleaned.where(F.col("id") == 1).first().organization_cleaned == "GSA, General Services Administration"
