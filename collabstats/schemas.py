"""Table schemas, labels and fixed lookup values.

Everything here is data, not logic: the column lists that describe the raw and
cleaned user/commit tables, the labels the reports use, and the agency rule
table and agency report order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column lists of the raw user tables (fixed values: the input format)
# ---------------------------------------------------------------------------

COUNTRY_COLUMNS = [
    "country_location",
    "country_email",
    "country_government",
    "country_academic",
]

# Organisation columns in concatenation order.  The first source also carries
# `organization`; both end with the derived agency (`new_agencies`).
ORG_COLUMNS_BASE = [
    "organization_company_business",
    "organization_email_business",
    "organization_company_government",
    "organization_email_government",
    "organization_company_academic",
    "organization_email_academic",
    "organization_company_nonprofit",
    "organization_email_nonprofit",
]
ORG_COLUMNS_PRIMARY = ORG_COLUMNS_BASE + ["organization", "new_agencies"]
ORG_COLUMNS_SECONDARY = ORG_COLUMNS_BASE + ["new_agencies"]

# Sector flags in the order the sector list is built.
SECTOR_FLAGS = ["nonprofit", "government", "business", "academic"]

RAW_USERS_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("login", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in COUNTRY_COLUMNS]
    + [T.StructField(c, T.StringType()) for c in ORG_COLUMNS_PRIMARY]
    + [T.StructField(c, T.IntegerType()) for c in SECTOR_FLAGS]
)

RAW_USERS_SECONDARY_SCHEMA = T.StructType(
    [T.StructField("id", T.LongType()), T.StructField("login", T.StringType())]
    + [T.StructField(c, T.StringType()) for c in COUNTRY_COLUMNS]
    + [T.StructField(c, T.StringType()) for c in ORG_COLUMNS_BASE]
    + [T.StructField(c, T.IntegerType()) for c in SECTOR_FLAGS]
)

RAW_COMMITS_SCHEMA = T.StructType(
    [
        T.StructField("branch", T.StringType()),
        T.StructField("authors_id", T.ArrayType(T.LongType())),
        T.StructField("committedat", T.TimestampNTZType()),
    ]
)

RAW_COMMITS_SECONDARY_SCHEMA = T.StructType(
    [
        T.StructField("userid", T.LongType()),
        T.StructField("repoid", T.StringType()),
        T.StructField("commityear", T.TimestampNTZType()),
    ]
)

USERS_CLEAN_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("login", T.StringType()),
        T.StructField("country_cleaned", T.StringType()),
        T.StructField("organization_cleaned", T.StringType()),
        T.StructField("sector", T.StringType()),
    ]
)

COMMITS_YEARLY_SCHEMA = T.StructType(
    [
        T.StructField("branch", T.StringType()),
        T.StructField("author_id", T.LongType()),
        T.StructField("commit_year", T.LongType()),
    ]
)

COMMITS_FIRST_SCHEMA = T.StructType(
    [
        T.StructField("author_id", T.LongType()),
        T.StructField("branch", T.StringType()),
        T.StructField("min_commit_year", T.LongType()),
    ]
)

# ---------------------------------------------------------------------------
# Report parameters and labels (fixed values)
# ---------------------------------------------------------------------------

FIRST_YEAR = 2009
LAST_YEAR = 2023
REPORT_YEARS = list(range(FIRST_YEAR, LAST_YEAR + 1))

US = "United States"
US_LONG = "United States of America"
MISSING_COUNTRY = "Missing Country"   # label of the single-year country reports
MISSING = "Missing"                   # label of the multi-year sector/country reports
UNCLASSIFIED = "Unclassified"

# Agency classification rules, evaluated in this order, first
# match wins.  (label, pattern, ignore_case)
AGENCY_RULES = [
    ("Department of Agriculture", "USDA|Agriculture", True),
    ("Department of Commerce", "US National Institute of Standards and Technology|US NOAA Fisheries|US National Weather Service|Department of Commerce|US Bureau of Economic Analysis|US International Trade Administration|US National Ocean Service|US Patent and Trademark Office", True),
    ("Department of the Interior", "USGS|Interior|National Park Service|Bureau of Land Management|Bureau of Reclamation", True),
    ("Department of Defense", "Department of Defense", True),
    ("Department of Energy", "Lab(oratory|oratories)|Energy|Oak Ridge|Princeton Plasma", True),
    ("Department of Health and Human Services", "National Institutes of Health|Centers for Disease Control and Prevention|National Cancer Institute|National Library of Medicine|Health and Human Services|National Institute on Aging|National Institute on Drug Abuse", False),
    ("Department of Homeland Security", "Department of Homeland Security|USCIS|FEMA", False),
    ("Department of Justice", "Investigation|Justice|Unicor", True),
    ("Department of Labor", r"\bLabor\b", True),
    ("Department of Transportation", "Transportation|Enterprise|Aviation|NHTSA", False),
    ("Department of Veterans Affairs", "Department of Veterans Affairs", True),
    ("Environmental Protection Agency", "Environmental Protection Agency", True),
    ("Federal Election Commission", "Federal Election Commission", True),
    ("General Services Administration", "General Services Administration|GSA|FAI", False),
    ("National Aeronautics and Space Administration", "National Aeronautics and Space Administration", False),
    ("National Science Foundation", "US National Science Foundation", False),
    ("Office of Personnel Management", "OPM", False),
    ("Social Security Administration", "Social Security Administration", False),
    ("Department of State", "Dept of State|US Department of State", False),
]

# The agencies reported individually, in report order.
AGENCY_LIST = [
    "Agency for International Development",
    "Department of Agriculture",
    "Department of Commerce",
    "Department of the Interior",
    "Department of Defense",
    "Department of Education",
    "Department of Energy",
    "Department of Health and Human Services",
    "Department of Homeland Security",
    "Department of Housing and Urban Development",
    "Department of Justice",
    "Department of Labor",
    "Department of the Treasury",
    "Department of Transportation",
    "Department of Veterans Affairs",
    "Environmental Protection Agency",
    "Federal Election Commission",
    "General Services Administration",
    "National Aeronautics and Space Administration",
    "National Science Foundation",
    "Office of Personnel Management",
    "Small Business Administration",
    "Social Security Administration",
    "Department of State",
]
FEDERAL_TOTAL = "Federal Total"
ALL_OTHER_FEDERAL = "All Other Federal"

# Sector report rows and recoding.
SECTOR_RECODE = {
    "academic": "Academic",
    "government": "Government",
    "business": "Business",
    "nonprofit": "Nonprofit",
}
SECTOR_ROW_ORDER = [
    "Total Repos",
    "Total (Global)",
    "Total (US)",
    "Academic",
    "Government",
    "Business",
    "Nonprofit",
    "Unclassified",
    "Total (Missing Country)",
]

# Institution report blocks (sector, header, total, other, excluded orgs).
INSTITUTION_BLOCKS = [
    ("business", "Top {n} Businesses (Global)", "Business Total", "All Other Business", ["", "Misc. Business"]),
    ("academic", "Top {n} Universities (Global)", "Academic Total", "All Other Academic", ["", "Misc. Academic"]),
]

# Display headers used by the report sink.
DISPLAY_HEADERS = {
    "collab_by_country": {
        "country": "Country",
        "collaborations_with_us": "Collaborations with United States",
        "collaborations_with_non_us": "Collaborations with non-U.S. countries or economies",
        "collaborations_non_us_excl_us": "Collaborations with non-U.S. countries or economies, excluding U.S.",
    },
    "codeveloped_pairs": {
        "country_1": "Country 1",
        "country_2": "Country 2",
        "co_developed_repositories": "Co-developed repositories",
    },
    "fractional_by_country": {"country": "Country", "total_repositories": "Total repositories"},
    "agency_totals": {"institution": "Institution", "n_repositories": "Number of repositories"},
    "agency_new_by_year": {"institution": "Institution"},
    "top_institutions": {"institution": "Institution", "n_repositories": "Number of repositories"},
    "sectors_by_year": {"sector": "Sector"},
    "countries_by_year": {"country": "Country"},
}

# Row order of the reports without a fixed list ("-": descending); the others carry `row_order`.
REPORT_ORDER = {
    "collab_by_country": ["-collaborations_with_us", "country"],
    "codeveloped_pairs": ["-co_developed_repositories", "country_1", "country_2"],
    "fractional_by_country": ["-total_repositories", "country"],
}
