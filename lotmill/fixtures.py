"""Listing tables derived from the order tables, for queries and tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill.operators.cards import CARD
from lotmill.operators.merge import with_versioning
from lotmill.schemas import CLEAN_COLUMNS, RAW_COLUMNS

AS_OF = datetime(2024, 1, 31, 12, 0, 0)
STORED_AT = datetime(2024, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation, region = (
        table(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region")
    )
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("k", F.col("o_orderkey"))
    )


def _whole(c: Column) -> Column:
    return F.format_number(F.floor(c).cast("bigint"), 0)


def _every(n: int) -> Column:
    return F.col("k") % n == 0


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text listings, one per order, with ``k`` and ``file_name``."""
    wide = _orders_wide(spark, sf_dir)
    k, price = F.col("k"), F.col("o_totalprice")
    area = F.lower(F.replace(F.concat_ws("-", "r_name", "o_orderpriority"), F.lit(" "), F.lit("-")))
    day = F.lower(F.date_format("o_orderdate", "d MMM yyyy"))
    amount = F.concat(F.lit("rm "), _whole(price))
    columns = {
        "Page_Link": F.when(_every(41), None)
        .when(_every(43), "")
        .otherwise(
            F.concat(
                F.lit("https://www.example.com.my/property/"),
                area,
                F.lit("/sale-"),
                k,
                F.when(_every(2), "/").otherwise(""),
            )
        ),
        "Source": F.lit("example"),
        "Agent_Name": F.when(_every(29), None)
        .when(_every(31), "nancy lim")
        .otherwise(F.concat(F.lit("agent  no-"), F.col("o_custkey") % 97)),
        "Posted_Date": F.when(k % 5 == 0, "posted today 09:30 am")
        .when(k % 5 == 1, "posted yesterday")
        .when(k % 5 == 2, F.concat(F.lit("posted on "), day))
        .when(k % 5 == 3, F.concat(F.lit("posted on "), day, F.lit(" 02:15 pm")))
        .otherwise("unknown"),
        "House_Price": F.when(_every(17), "contact for price")
        .when(
            _every(13),
            F.concat(F.lit("from "), amount, F.lit(" - rm "), _whole(F.floor(price) * 4)),
        )
        .when(_every(11), F.concat(amount, F.lit(",000")))
        .when(_every(7), F.concat(amount, F.lit(".50")))
        # Zeros in the middle of nine digits, and three commas before a last 000.
        .when(k % 10 == 3, F.concat(F.lit("rm 150,000,"), F.lpad((k % 1000).cast("string"), 3, "0")))
        .when(
            k % 10 == 7,
            F.concat(F.lit("rm 1,234,"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit(",000")),
        )
        .otherwise(amount),
        "Price_Square_Feet": F.when(_every(19), None).otherwise(
            F.concat(F.lit("rm "), _whole(price / 10), F.lit(".50"))
        ),
        "House_Name": F.lower(F.concat(F.lit("residence "), "c_name")),
        "House_Location": F.lower(F.concat_ws(", ", "n_name", "r_name")),
        "House_Type": F.when(F.col("c_mktsegment") == "BUILDING", "2-sty terrace/link house")
        .when(F.col("c_mktsegment") == "AUTOMOBILE", "town homes")
        .when(F.col("c_mktsegment") == "MACHINERY", F.when(_every(3), "Bungalow").otherwise("bungalow"))
        .when(
            F.col("c_mktsegment") == "HOUSEHOLD",
            F.when(_every(3), "Residential Land").otherwise("residential land"),
        )
        .otherwise("condominium"),
        "Lot_Type": F.when(_every(2), "corner  lot").otherwise("intermediate"),
        "Square_Footage": F.when(k % 4 == 0, "from 1200 - 1500")
        .when(k % 4 == 1, "1,350")
        .when(k % 4 == 2, "900.5 sqft"),
        "House_Furniture": F.when(F.col("o_orderstatus") == "F", "fully furnished")
        .when(F.col("o_orderstatus") == "P", "partly furnished")
        .otherwise("unfurnished"),
        "Created_At": F.lit("2024-01-31 12:00:00"),
    }
    file_name = F.concat(
        F.lit("batch1_01_"),
        F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))),
        F.lit("_listings_20240131_120000.csv"),
    )
    return wide.select(
        "k", *[columns[c].alias(c) for c in RAW_COLUMNS], file_name.alias("file_name")
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value, file_name): lines of raw files with quoted cells, headers first; some are no good records.

    Every 19th has a price with an unquoted comma, every 23rd ends after three cells, every 29th leaves a quote open.
    """
    rows = listings_raw(spark, sf_dir)
    quoted = {c: F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in RAW_COLUMNS}
    priced = F.concat_ws(",", *(F.lit("rm 500,000") if c == "House_Price" else quoted[c] for c in RAW_COLUMNS))
    cut = F.concat_ws(",", *(quoted[c] for c in RAW_COLUMNS[:3]))
    opened = F.concat_ws(",", *(F.rtrim(quoted[c], F.lit('"')) if c == "House_Name" else quoted[c] for c in RAW_COLUMNS))
    line = F.when(_every(19), priced).when(_every(23), cut).when(_every(29), opened)
    lines = rows.select(F.lit(1).alias("place"), "file_name", line.otherwise(F.concat_ws(",", *quoted.values())).alias("value"))
    header = rows.select("file_name").distinct().select(F.lit(0).alias("place"), "file_name", F.lit(",".join(RAW_COLUMNS)).alias("value"))
    both = header.unionByName(lines).repartition("file_name").sortWithinPartitions("file_name", "place")
    return both.select("value", "file_name")


def _decimal(c: Column) -> Column:
    return c.cast("decimal(20,2)")


def listings_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean listings, one per order."""
    wide = _orders_wide(spark, sf_dir)
    price, area = F.col("o_totalprice"), F.concat_ws("-", "r_name", "o_orderpriority")
    columns = {
        "property_id": F.col("k").cast("string"),
        "page_link": F.concat(F.lit("https://www.example.com.my/property/"), area, F.lit("/"), "k"),
        "source": F.lit("example"),
        "agent_name": F.concat(F.lit("Agent "), F.col("o_custkey") % 97),
        "state": F.col("n_name"),
        "area": area,
        "house_price": _decimal(price),
        "price_square_feet": _decimal(F.floor(price) / 100),
        "house_name": F.concat(F.lit("Residence "), "c_name"),
        "house_location": F.concat_ws(", ", "n_name", "r_name"),
        "house_type": F.col("c_mktsegment"),
        "lot_type": F.when(_every(2), "Corner Lot").otherwise("Intermediate"),
        "square_footage": _decimal(F.lit(900) + F.col("k") % 600),
        "house_furniture": F.when(F.col("o_orderstatus") == "F", "Fully Furnished")
        .when(F.col("o_orderstatus") == "P", "Partly Furnished")
        .otherwise("Unfurnished"),
        "posted_date": F.col("o_orderdate").cast("timestamp_ntz"),
        "created_at": F.col("o_orderdate").cast("timestamp_ntz"),
    }
    return wide.select(*[columns[c].alias(c) for c in CLEAN_COLUMNS])


def listings_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table: every order's listing, loaded at an earlier time."""
    return with_versioning(listings_typed(spark, sf_dir), STORED_AT)


def listings_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch from all line items.

    Line 1 lists its order's property again; other lines are new units. Many
    (order, line) pairs occur more than once, so the batch repeats keys.
    """
    items = table(spark, sf_dir, "lineitem")
    unit = F.when(F.col("l_linenumber") == 1, "").otherwise(F.concat(F.lit("-"), "l_linenumber"))
    shipped = F.col("l_shipdate").cast("timestamp_ntz")
    ident = F.concat(F.col("l_orderkey").cast("string"), unit)
    columns = {
        "property_id": ident,
        "page_link": F.concat(F.lit("https://www.example.com.my/property/unit/"), ident),
        "source": F.lit("example"),
        "agent_name": F.concat(F.lit("Agent "), F.col("l_suppkey") % 97),
        "state": F.concat(F.lit("STATE "), "l_returnflag"),
        "area": F.concat(F.lit("AREA "), F.col("l_partkey") % 50),
        "house_price": _decimal(F.col("l_extendedprice")),
        "price_square_feet": _decimal(F.floor("l_extendedprice") / 100),
        "house_name": F.concat(F.lit("Unit "), "l_partkey"),
        "house_location": F.concat(F.lit("Block "), "l_suppkey"),
        "house_type": F.concat(F.lit("TYPE "), "l_linestatus"),
        "lot_type": F.concat(F.lit("LOT "), "l_linenumber"),
        "square_footage": _decimal(F.col("l_quantity") * 10),
        "house_furniture": F.lit("Unfurnished"),
        "posted_date": shipped,
        "created_at": shipped,
    }
    return items.select(*[columns[c].alias(c) for c in CLEAN_COLUMNS])


def attribute_text() -> Column:
    """Card attribute text of a raw listing."""
    area = F.regexp_extract("House_Price", r"rm ([0-9,]+)", 1)
    return F.concat(
        "House_Type",
        F.lit(" | "),
        "Lot_Type",
        F.lit(" • Built-up : "),
        area,
        F.lit(" sq. ft. • "),
        "House_Furniture",
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages of 20 raw listings as HTML cards, every page visited twice.

    The first visit of every fifth page shows a challenge, and the second of every
    seventh has no URL.
    """

    def tag(name: str, mark: str, body: Column) -> Column:
        return F.when(
            body.isNotNull(),
            F.concat(F.lit(f'<{name} class="x {mark} y">'), body, F.lit(f"</{name}>\n")),
        ).otherwise("")

    def within(mark: str, body: Column, name: str = "div") -> Column:
        return F.concat(F.lit(f'<{name} class="{mark}">'), body, F.lit(f"</{name}>\n"))

    def either(first: Column, second: Column) -> Column:
        """One of a field's two alternatives."""
        return F.when(_every(2), second).otherwise(first)

    address = F.concat(
        F.lit('<a class="depth-listing-card-link" href="'), "Page_Link", F.lit('"><img src="p.jpg"></a>')
    )
    button = within("ListingContactDetailsButtonstyle__ButtonItem", address, "button")
    link = F.when(
        F.col("Page_Link").isNotNull(),
        F.when(_every(3), within("slick-slide slick-active slick-current", address))
        .when(F.col("k") % 3 == 1, within("BasicCardstyle__ListingImageWrapper-iZfXFa kjZOzk", address))
        .otherwise(within("ListingContactDetailsButtonstyle__ButtonsWrapper", button)),
    ).otherwise("")
    described = "BasicCardstyle__DescriptionWrapper-dPdKmp fRMZJr"
    agent = F.concat(F.lit("<b>"), "Agent_Name", F.lit("</b>"))
    psf = F.concat(F.lit("("), "Price_Square_Feet", F.lit(" per sq. ft.)"))
    card = F.concat(
        F.lit(f'<li class="{CARD[1]} z"><!-- card -->'),
        link,
        either(tag("div", "ListingHeadingstyle__HeadingTitle", agent), tag("div", "heading-name", agent)),
        either(
            tag("p", "ListingHeadingstyle__HeadingCreationDate", F.col("Posted_Date")),
            within(
                "BasicCardstyle__HeadingWrapper-DxbUP knxJEk",
                tag("p", "heading-creation-date", F.col("Posted_Date")),
            ),
        ),
        F.lit("<ul>"),
        either(tag("li", "ListingPricestyle__ItemWrapper", F.col("House_Price")), F.lit("")),
        F.lit("</ul>"),
        either(F.lit(""), tag("div", "ListingPricestyle__RangePriceWrapper", F.col("House_Price"))),
        tag("div", "ListingPricestyle__PricePSFWrapper", psf),
        either(
            tag("h2", "PremiumCardstyle__TitleWrapper", F.col("House_Name")),
            within(described, tag("h2", "BasicCardstyle__TitleWrapper-eNIiIX dLdNwJ", F.col("House_Name"))),
        ),
        either(
            tag("div", "PremiumCardstyle__AddressWrapper", F.col("House_Location")),
            within(described, tag("div", "BasicCardstyle__AddressWrapper-jUpzVZ jikSUL", F.col("House_Location"))),
        ),
        tag(
            "p",
            "ListingAttributesstyle__ListingAttrsDescriptionItemWrapper",
            F.replace(attribute_text(), F.lit("•"), F.lit("&bull;")),
        ),
        F.lit("</li>"),
    )
    raw = listings_raw(spark, sf_dir)
    # Twenty consecutive order keys, which are unique, make one page.
    pages = (
        raw.select(F.floor(F.col("k") / 20).alias("page_no"), F.struct("k", card.alias("c")).alias("s"))
        .groupBy("page_no")
        .agg(F.array_sort(F.collect_list("s")).alias("cards"))
    )
    html = F.concat(
        F.lit("<!DOCTYPE html><html><body><script>var a='<li>';</script><ul>"),
        F.array_join(F.col("cards.c"), "\n"),
        F.lit("</ul></body></html>"),
    )
    visits = F.explode(F.array(F.lit(0), F.lit(1)))
    challenge = (F.col("page_no") % 5 == 0) & (F.col("visit") == 0)
    nameless = (F.col("page_no") % 7 == 0) & (F.col("visit") == 1)
    url = F.concat(F.lit("https://www.example.com.my/sale?page="), "page_no")
    return pages.select("page_no", html.alias("html"), visits.alias("visit")).select(
        (F.col("page_no") * 2 + F.col("visit")).alias("page_id"),
        F.when(~nameless, url).alias("url"),
        F.when(challenge, F.concat(F.lit("<p>Checking your browser</p>"), "html")).otherwise(F.col("html")).alias("html"),
    )
