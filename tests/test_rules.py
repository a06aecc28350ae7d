"""Golden rows of the cleaning and card rules."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import NOON, physical_plan, raw_rows, values
from lotmill.functions import cards, dates, links, prices, text
from lotmill.operators.clean import clean_listings, quarantine
from lotmill.queries import _cleaned_whole

PRICES = {
    "rm 450,000": 450000.0,
    "rm 450,000,000": 450000.0,
    "rm 150,000,123": 1500123.0,
    "rm 123,456,789": 123456789.0,
    "rm 1,200,000,000": 1200000.0,
    "from rm 500,000 - rm 900,000": 700000.0,
    "rm 500,000 - rm 1,200,000": 250600.0,
    "rm 1,200,000 - rm 1,500,000": 600750.0,
    "rm 450,000.50": None,
    "rm 24,999": None,
    "rm 25,000": 25000.0,
    "rm 999,999": 999999.0,
    "contact for detail": None,
    "abc": None,
}


def test_prices_through_cleaning(spark):
    rows = [{"House_Price": p, "Agent_Name": p} for p in PRICES]
    got = {
        r.house_name: float(r.house_price)
        for r in clean_listings(
            raw_rows(spark, [{**r, "House_Name": str(i)} for i, r in enumerate(rows)]), NOON
        ).collect()
    }
    expected = {str(i): v for i, v in enumerate(PRICES.values()) if v is not None}
    assert got == expected


def _by_hand(price: str, house_type: str) -> str:
    """The three digit rules, step by step."""
    digits = lambda s: "".join(c for c in s if c.isdigit())
    if house_type not in ("Residential Land", "Bungalow"):
        d = digits(price)
        if price.count(",") == 2 and len(d) == 9 and d[-3:] != "000":
            price = price.replace(",000", ",0", 1)
        d = digits(price)
        if price.count(",") == 2 and len(d) == 9 and d[-3:] == "000":
            price = price[:-4]
    d = digits(price)
    if house_type != "Residential Land":
        if price.count(",") >= 3 and len(d) >= 9 and d[-3:] == "000":
            price = price[:-4]
    return price.replace(",", "")


@pytest.mark.parametrize("house_type", ["condominium", "Bungalow", "Residential Land", None])
def test_digit_rules_against_steps(spark, house_type):
    parts = ["000", "123", "450", "7", "20", "1,000", "900,000", "450,000,000", "1,000,0", "0"]
    texts = [",".join([a, b, c]) for a in parts for b in parts for c in parts]
    texts += [f"{a},{b}" for a in parts for b in parts] + [f"{a} - {b}" for a in parts for b in parts]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, c string").withColumn(
        "t", F.lit(house_type).cast("string")
    )
    out = df.select("i", prices.price_text(F.col("c"), F.col("t")).alias("v")).collect()
    assert {r.i: r.v for r in out} == {i: _by_hand(t, house_type) for i, t in rows}


def test_fix_ranges_treats_bounds_apart(spark):
    row = raw_rows(spark, [{"House_Price": "rm 1,200,000 - rm 1,500,000"}])
    assert float(clean_listings(row, NOON, fix_ranges=True).first().house_price) == 1350000.0
    three = raw_rows(spark, [{"House_Price": "rm 1 - rm 2 - rm 3"}])
    assert quarantine(three, NOON, fix_ranges=True).first().reject_reason == "price_range"


def test_null_types_and_prices(spark):
    rows = raw_rows(spark, [{"House_Type": None}, {"House_Price": None}])
    got = clean_listings(rows, NOON).collect()
    assert [(float(r.house_price), r.house_type) for r in got] == [(450000.0, "")]


def test_posted_dates(spark):
    cases = {
        "02 sep 2023 09:05 pm": datetime(2023, 9, 2, 21, 5),
        "2 sep 2023": datetime(2023, 9, 2),
        "32 jan 2024": None,
        "12 january 2024": None,
        "12 jan 2024 13:00 pm": None,
        "posted on 12 jan 2024": datetime(2024, 1, 12),
        "posted on 12 jan 2024 12:00 am": datetime(2024, 1, 12),
        "posted today 09:30 am": datetime(2024, 1, 31, 9, 30),
        "posted today": None,
        "posted yesterday": datetime(2024, 1, 30),
        "posted yesterday 02:15 pm": datetime(2024, 1, 30, 14, 15),
        "unknown": None,
        "": None,
        None: None,
    }
    got = values(spark, list(cases), lambda c: dates.posted_date(c, NOON))
    assert got == list(cases.values())


def test_posted_dates_do_not_depend_on_the_zone(spark):
    # The hour that New York skipped.
    texts = ["posted on 10 mar 2024 02:30 am", "10 mar 2024", "30 feb 2024", "1 nov 2024 12:60 am"]
    found = []
    zone = spark.conf.get("spark.sql.session.timeZone")
    for other in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", other)
        try:
            found.append(values(spark, texts, lambda c: dates.posted_date(c, NOON)))
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] == [datetime(2024, 3, 10, 2, 30), datetime(2024, 3, 10), None, None]


def test_yesterday_crosses_a_year(spark):
    got = values(spark, ["yesterday"], lambda c: dates.posted_date(c, datetime(2024, 1, 1, 3)))
    assert got == [datetime(2023, 12, 31)]


def test_square_footage(spark):
    cases = {"from 1200 - 1500": 1200.0, "1,350": 1350.0, "900.5 sqft": 900.5, "1.2.3": None,
             "sqft": None, None: None}
    assert values(spark, list(cases), prices.square_footage) == list(cases.values())


def test_price_per_square_foot(spark):
    cases = {"rm 1,234.50": 1234.5, "45": 45.0, "ask": None, "1d": None, " 7 ": 7.0, None: None}
    assert values(spark, list(cases), prices.psf_value) == list(cases.values())


def test_capitalize_and_synonyms(spark):
    cases = {
        "2-sty terrace/link house": "2 Storey Terrace/Link House",
        "town homes": "Town House",
        "agent  no-5": "Agent No 5",
        "a\xa0b": "A B",
        "a\tb \u3000c--d": "A B C D",
        "  semi-d HOUSE ": "Semi D House",
        None: None,
    }
    rule = lambda c: text.expand_house_type(text.capitalize_words(c))
    assert values(spark, list(cases), rule) == list(cases.values())


def test_blank_nan(spark):
    cases = {"Nancy Lim": "", "nan": "", "NaN x": "", "na": "na", "Anan": "Anan", None: ""}
    assert values(spark, list(cases), text.blank_nan) == list(cases.values())
    strict = values(spark, list(cases), lambda c: text.blank_nan(c, strict=True))
    assert strict == ["Nancy Lim", "", "NaN x", "na", "Anan", ""]


def test_missing_tokens_match_exactly(spark):
    texts = ["", "NULL", "null", "nan", "NaN", "n/a", "None", "none", " null", "na", "NA", "x"]
    got = values(spark, texts, text.missing_to_null)
    assert got == [None] * 7 + ["none", " null", "na", None, "x"]


def test_normalize_strips_all_whitespace(spark):
    assert values(spark, ["\u3000 A b\xa0\t\n", "x"], text.normalize) == ["a b", "x"]


def test_links(spark):
    urls = ["https://x.com/property/kl-city/sale-123/", "https://x.com/property/kl/sale-9", "a//", "plain", ""]
    assert values(spark, urls, links.property_id) == ["sale-123", "sale-9", "", "plain", ""]
    assert values(spark, urls, links.area_slug) == ["kl-city", "kl", "", "", ""]
    hosts = ["https://www.site.com.my/a", "https://site.com", "https://host/a", "relative/path", None]
    assert values(spark, hosts, links.source_name) == ["site", "com", None, None, None]


def test_state_from_file_name_or_path(spark):
    names = [
        "batch1_01_kuala-lumpur_site_20240131_120000.csv",
        "file:/raw/file_name=batch12_06_negeri-sembilan_site_20240131_120000.csv/part-0.csv",
        "listings.csv",
    ]
    assert values(spark, names, links.state_name) == ["Kuala Lumpur", "Negeri Sembilan", None]
    assert values(spark, names, links.script_number) == ["01", "06", None]


def test_card_texts(spark):
    psf = ["(rm 450.00 per sq. ft.)", "rm  7", "((x y", "rm", None, "( rm 1"]
    assert values(spark, psf, cards.psf_text) == ["rm 450.00", "rm 7", "x y", None, None, " rm"]
    attrs = [
        "Condo | Corner lot • Built-up : 1,350 sq. ft. • Fully Furnished",
        "Land • Land area : 2,000 sq. ft.",
        "Bungalow",
        "Semi-D | Corner",
    ]
    assert values(spark, attrs, cards.house_type) == ["Condo", "Land", "Bungalow", "Semi-D"]
    assert values(spark, attrs, cards.lot_type) == ["Corner lot", None, None, "Corner"]
    assert values(spark, attrs, cards.floor_area) == ["1350", "2000", None, None]
    assert values(spark, attrs, cards.furniture) == ["Fully Furnished", None, None, None]


def test_quarantine_reasons(spark):
    rows = raw_rows(
        spark,
        [
            {"House_Name": "ok"},
            {"House_Name": "r", "House_Price": "rm 1 - rm x"},
            {"House_Name": "p", "Price_Square_Feet": "ask"},
            {"House_Name": "f", "file_name": "x.csv"},
            {"House_Name": "low", "House_Price": "rm 1", "file_name": "x.csv"},
            {"House_Name": "nolink", "Page_Link": ""},
        ],
    )
    got = {r.house_name: r.reject_reason for r in quarantine(rows, NOON).collect()}
    assert got == {"R": "price_range", "P": "price_square_feet", "F": "file_name"}
    assert [r.house_name for r in clean_listings(rows, NOON).collect()] == ["Ok"]


def test_raw_columns_are_worked_out_once(spark):
    made = raw_rows(spark, [{}]).withColumn("House_Price", F.concat(F.lit("rm "), F.crc32("Source").cast("string")))
    assert physical_plan(_cleaned_whole(made)).count("crc32(") == 1
