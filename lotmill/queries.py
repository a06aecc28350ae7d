"""The registered queries: one per operator, over the whole order tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotmill import fixtures as fx
from lotmill.functions import cards, dates, hashing, links, prices, text
from lotmill.operators import clean, dedup, gate, merge
from lotmill.operators.cards import extract_listings, without_challenges
from lotmill.plans import marts, partials, star
from lotmill.plans.load import LoadOptions, current_table, stored
from lotmill.schemas import CLEAN_COLUMNS, CLEAN_TYPES, RAW_COLUMNS, create_table, typed_columns
from lotmill.session import scratch_folder
from lotmill.sources import files, regions, tables
from lotmill.streaming.ingest import start_ingest
from lotmill.streaming.visits import start_visits

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EARLY, BETWEEN, REVISIT_AT = "2023-12-31 12:00:00", "2024-02-15 12:00:00", "2024-02-29 12:00:00"


def _query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _shown(df: DataFrame, *columns: str) -> DataFrame:
    """Lower-case names, and decimals as doubles, for comparison across engines."""
    types = dict(df.dtypes)
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for name in columns or tuple(by_lower):
        c = F.col(by_lower[name])
        if types[by_lower[name]].startswith("decimal"):
            c = c.cast("double")
        out.append(c.alias(name))
    return df.select(*out)


def _rule(spark: SparkSession, sf_dir: str, **columns: Column) -> DataFrame:
    return fx.listings_raw(spark, sf_dir).select("k", *[c.alias(n) for n, c in columns.items()])


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_listings(fx.listings_raw(spark, sf_dir), fx.AS_OF)


def _cleaned_whole(rows: DataFrame) -> DataFrame:
    """Clean listings of which every column is wanted: what makes the raw columns is worked out once, not again for each filter."""
    return clean.clean_listings(clean.settled(rows), fx.AS_OF)


# Sources and sinks


@_query
def raw_scan(spark, sf_dir):
    folder = scratch_folder(spark, "raw")
    files.write_raw(fx.listings_raw(spark, sf_dir), folder)
    rows = files.read_raw(spark, folder)
    return _shown(rows.withColumn("region", links.region_slug(F.col("file_name"))).drop("file_name"))


def _with_tokens(spark, sf_dir):
    k = F.col("k")
    token = F.when(k % 7 == 0, "n/a").when(k % 7 == 1, "NULL").when(k % 7 == 2, "nan")
    token = token.when(k % 7 == 3, "").when(k % 7 == 4, "none").otherwise(F.col("House_Name"))
    return fx.listings_raw(spark, sf_dir).withColumn("House_Name", token)


@_query
def null_tokens(spark, sf_dir):
    rows = clean.with_missing_as_null(_with_tokens(spark, sf_dir))
    return _shown(rows, "k", "page_link", "agent_name", "house_name", "square_footage")


def _broken(spark, sf_dir):
    k = F.col("k")
    three = F.lit("rm 100,000 - rm 200,000 - rm 300,000")
    return fx.listings_raw(spark, sf_dir).withColumns(
        {
            "House_Price": F.when(k % 23 == 0, three).otherwise(F.col("House_Price")),
            "Price_Square_Feet": F.when(k % 37 == 0, "ask agent").otherwise(
                F.col("Price_Square_Feet")
            ),
            "file_name": F.when(k % 53 == 0, "listings.csv").otherwise(F.col("file_name")),
        }
    )


@_query
def quarantine(spark, sf_dir):
    broken = _broken(spark, sf_dir)
    return clean.quarantine(broken, fx.AS_OF).select("property_id", "reject_reason")


@_query
def insert_ignore(spark, sf_dir):
    new = merge.insert_ignore(
        fx.listings_current(spark, sf_dir), fx.listings_incoming(spark, sf_dir)
    )
    return _shown(new, *CLEAN_COLUMNS)


@_query
def upsert_latest(spark, sf_dir):
    stored, batch = fx.listings_current(spark, sf_dir), fx.listings_incoming(spark, sf_dir)
    merged = tables.merged_in_buckets(merge.upsert_latest, stored, batch, fx.AS_OF, scratch_folder(spark, "merge"))
    return _shown(merged).drop("valid_to")


@_query
def merge_if_newer(spark, sf_dir):
    stored, batch = fx.listings_current(spark, sf_dir), fx.listings_incoming(spark, sf_dir)
    merged = tables.merged_in_buckets(merge.merge_if_newer, stored, batch, fx.AS_OF, scratch_folder(spark, "merge"))
    return _shown(merged).drop("valid_to")


@_query
def merge_counts(spark, sf_dir):
    return merge.merge_counts(
        fx.listings_typed(spark, sf_dir), fx.listings_incoming(spark, sf_dir)
    )


@_query
def full_reload(spark, sf_dir):
    folder = scratch_folder(spark, "staging")
    files.write_staging(_cleaned_whole(fx.listings_raw(spark, sf_dir)), f"{folder}/staging_data.csv", "csv")
    store = tables.CurrentTable(spark, scratch_folder(spark, "current"))
    loaded = tables.full_reload(store, files.read_staging_csv(spark, folder), fx.AS_OF)
    return _shown(loaded).drop("valid_to")


def _revisited(spark, sf_dir):
    """The same listings collected again later, the odd ones as new units."""
    unit = F.concat(F.rtrim("Page_Link", F.lit("/")), F.lit("-b"))
    return fx.listings_raw(spark, sf_dir).withColumns(
        {
            "Page_Link": F.when((F.col("k") % 2 == 1) & (F.col("Page_Link") != ""), unit).otherwise(
                F.col("Page_Link")
            ),
            "Agent_Name": F.lit("second agent"),
            "Created_At": F.lit(REVISIT_AT),
        }
    )


def _visit(spark, sf_dir, n, suffix, agent, when):
    """The same listings at another time, every n-th one as a new unit."""
    unit = F.concat(F.rtrim("Page_Link", F.lit("/")), F.lit(f"-{suffix}"))
    return fx.listings_raw(spark, sf_dir).withColumns(
        {
            "Page_Link": F.when((F.col("k") % n == 0) & (F.col("Page_Link") != ""), unit).otherwise(
                F.col("Page_Link")
            ),
            "Agent_Name": F.lit(agent),
            "Created_At": F.lit(when),
        }
    )


@_query
def append_dedup(spark, sf_dir):
    existing = fx.listings_raw(spark, sf_dir).select(*RAW_COLUMNS)
    again = existing.withColumns(
        {c: F.concat(F.lit(" \t"), F.upper(c), F.lit(" ")) for c in RAW_COLUMNS}
    )
    later = _revisited(spark, sf_dir).select(*RAW_COLUMNS).drop("Square_Footage")
    once = dedup.append_dedup(existing, again)
    return _shown(dedup.append_dedup(once, later))


@_query
def state_from_file(spark, sf_dir):
    return _rule(spark, sf_dir, state=links.state_name(F.col("file_name")))


@_query
def schema_from_json(spark, sf_dir):
    schema = json.loads(json.dumps({f"[{c}]": t for c, t in CLEAN_TYPES.items()}))
    typed = fx.listings_typed(spark, sf_dir)
    as_text = typed.select(*[F.col(c).cast("string").alias(c) for c in CLEAN_COLUMNS])
    price = F.when(F.col("lot_type") == "Corner Lot", F.concat("house_price", F.lit(" rm")))
    as_text = as_text.withColumn("house_price", price.otherwise(F.col("house_price")))
    return _shown(as_text.select(*typed_columns(schema)))


@_query
def region_dim(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir).select("k", "file_name")
    nation = F.regexp_extract("file_name", r"nation-(\d+)", 1).cast("int")
    script = F.lpad((nation % 16 + 1).cast("string"), 2, "0")
    renamed = F.replace("file_name", F.lit("_01_"), F.concat(F.lit("_"), script, F.lit("_")))
    numbered = raw.select(links.script_number(renamed).alias("script_number"))
    counted = numbered.groupBy("script_number").agg(F.count("*").alias("n_listings"))
    return counted.join(regions.region_dim(spark), "script_number")


@_query
def stream_ingest(spark, sf_dir):
    folder, state = scratch_folder(spark, "drop"), scratch_folder(spark, "stream")
    options = LoadOptions(only_newer=False, buckets=tables.buckets_for(spark, fx.listings_raw(spark, sf_dir)))
    store = current_table(spark, state, options)
    tables.full_reload(store, _cleaned_whole(_visit(spark, sf_dir, 3, "a", "first agent", EARLY)), fx.AS_OF)
    files.write_raw(fx.listings_raw(spark, sf_dir), folder)
    start_ingest(spark, folder, state, f"{state}/checkpoint", fx.AS_OF, options=options).awaitTermination()
    between = _cleaned_whole(_visit(spark, sf_dir, 5, "c", "third agent", BETWEEN))
    tables.incremental_load(store, between, fx.AS_OF, only_newer=False)
    files.write_raw(_revisited(spark, sf_dir), folder)
    start_ingest(spark, folder, state, f"{state}/checkpoint", fx.AS_OF, options=options).awaitTermination()
    return _shown(store.read()).drop("valid_to")


@_query
def ingest_rejects(spark, sf_dir):
    folder, root = scratch_folder(spark, "drop"), scratch_folder(spark, "stream")
    files.write_raw(_broken(spark, sf_dir), folder)
    start_ingest(spark, folder, root, f"{root}/checkpoint", fx.AS_OF).awaitTermination()
    return stored(spark, root, "rejected_listings").select("property_id", "reason")


@_query
def malformed_rows(spark, sf_dir):
    """Records with a comma too many, cut after three cells, or with a quote left open, set apart as they stand in their files."""
    folder, root = scratch_folder(spark, "drop"), scratch_folder(spark, "stream")
    fx.raw_lines(spark, sf_dir).write.partitionBy("file_name").text(folder)
    options = LoadOptions(multi_line=False)
    start_ingest(spark, folder, root, f"{root}/checkpoint", fx.AS_OF, options=options).awaitTermination()
    rejects = stored(spark, root, "rejected_listings").filter("reason = 'cells'")
    return rejects.select("reason", "raw_line")


@_query
def append_fingerprint(spark, sf_dir):
    """As append_dedup, into a stored archive that three batches are appended to."""
    archive = tables.raw_archive(spark, scratch_folder(spark, "archive"))
    existing = fx.listings_raw(spark, sf_dir).select(*RAW_COLUMNS)
    again = existing.withColumns({c: F.concat(F.lit(" \t"), F.upper(c), F.lit(" ")) for c in RAW_COLUMNS})
    for rows in (existing, again, _revisited(spark, sf_dir).select(*RAW_COLUMNS).drop("Square_Footage")):
        tables.append_raw(archive, rows)
    return _shown(archive.read().drop("fingerprint"))


@_query
def redelivered_batch(spark, sf_dir):
    """What a batch does to a table that holds part of it, and the same batch once more."""
    store = tables.CurrentTable(spark, scratch_folder(spark, "current"))
    typed = fx.listings_typed(spark, sf_dir)
    key = F.col("property_id").cast("long")
    tables.full_reload(store, typed.filter(key % 3 != 0), fx.AS_OF)
    price = F.when(key % 10 == 0, F.col("house_price") + 1000).otherwise(F.col("house_price"))
    batch = typed.withColumn("house_price", price.cast("decimal(20,2)"))
    out = None
    for name in ("first", "again"):
        store.merge(gate.passing(batch), fx.AS_OF, False, name)
        counts = store.images(name).groupBy("action").agg(F.sum("n_rows").alias("n_rows")).select(F.lit(name).alias("delivery"), "action", "n_rows")
        out = counts if out is None else out.unionByName(counts)
    return out


@_query
def bulk_copy(spark, sf_dir):
    """Rows that the gate passes, through a CSV file into a table created with lengths and NOT NULL."""
    cleaned, folder = _cleaned(spark, sf_dir), scratch_folder(spark, "copy")
    name = f"bulk_copy_{uuid.uuid4().hex}"
    create_table(spark, name, CLEAN_TYPES, not_null=True, path=f"{folder}/table")
    files.write_staging(gate.passing(cleaned), f"{folder}/staging_data.csv", "csv")
    files.copy_into(spark, f"{folder}/staging_data.csv", name, not_null=True)
    return _shown(spark.table(name), *CLEAN_COLUMNS)


@_query
def files_by_header(spark, sf_dir):
    """Files with the columns turned round, with columns missing, with one too many, and one of another table."""
    folder, rows = scratch_folder(spark, "raw"), fx.listings_raw(spark, sf_dir)
    kinds = [
        RAW_COLUMNS[::-1],
        [c for c in RAW_COLUMNS if c not in ("Square_Footage", "House_Furniture")],
        ["Note", *RAW_COLUMNS],
    ]
    named = rows.withColumn("Note", F.lit("x"))
    for i, kind in enumerate(kinds):
        own = named.filter(F.col("k") % len(kinds) == i).select(*kind)
        own.write.options(**files.CSV).csv(f"{folder}/kind {i}")
    fx.table(spark, sf_dir, "nation").write.options(**files.CSV).csv(f"{folder}/other")
    return _shown(files.read_raw(spark, folder).drop("file_name"))


# Extraction


@_query
def visited_once(spark, sf_dir):
    """Two runs over overlapping pages: each URL with the run that read it."""
    folder, root = scratch_folder(spark, "pages"), scratch_folder(spark, "visits")
    pages = fx.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    more = pages.withColumn("page_id", F.col("page_id") + 10_000_000)
    for run, part in enumerate((pages.filter("page_id % 3 <> 0"), pages.unionByName(more))):
        part.write.parquet(f"{folder}/{run}")
        start_visits(spark, folder, root, f"{root}/checkpoint", fx.AS_OF).awaitTermination()
    return spark.read.parquet(f"{root}/visits").select("url", (F.col("batch") + 1).cast("int").alias("run"))


@_query
def rejected_cards(spark, sf_dir):
    found = extract_listings(fx.listing_pages(spark, sf_dir), fx.AS_OF)
    return found.filter(F.col("reject_reason").isNotNull()).select("page_id", "card_no", "reject_reason")


@_query
def listings_from_html(spark, sf_dir):
    found = extract_listings(fx.listing_pages(spark, sf_dir), fx.AS_OF)
    kept = found.filter(F.col("reject_reason").isNull())
    return _shown(clean.normalize_raw(kept).select("page_id", "card_no", *RAW_COLUMNS))


@_query
def source_from_url(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return pages.select("page_id", links.source_name(F.col("url")).alias("source"))


@_query
def psf_text(spark, sf_dir):
    shown = F.concat(F.lit("(("), "Price_Square_Feet", F.lit("  /  sq. ft.)"))
    seen = F.when(F.col("k") % 9 == 0, "(rm)").otherwise(shown)
    return _rule(spark, sf_dir, psf=cards.psf_text(seen))


@_query
def attr_text(spark, sf_dir):
    rows = fx.listings_raw(spark, sf_dir).select("k", fx.attribute_text().alias("attrs"))
    attrs = F.col("attrs")
    return rows.select(
        "k",
        cards.house_type(attrs).alias("house_type"),
        cards.lot_type(attrs).alias("lot_type"),
        cards.floor_area(attrs).alias("square_footage"),
        cards.furniture(attrs).alias("house_furniture"),
    )


@_query
def page_dedup(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    visit = F.explode(F.array(F.lit(0), F.lit(1)))
    # Only the length of a body goes on, so no body is shuffled.
    sized = pages.select("page_id", "url", F.length("html").alias("n_chars"))
    visits = sized.withColumn("visit", visit)
    visits = visits.select((F.col("page_id") * 2 + F.col("visit")).alias("page_id"), "url", "n_chars")
    return dedup.first_visits(visits, visits)


@_query
def page_filter(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    challenge = F.concat("html", F.lit("<p>Checking your browser</p>"))
    shown = F.when(F.col("page_id") % 7 == 0, challenge).otherwise(F.col("html"))
    kept = without_challenges(pages.withColumn("html", shown))
    return kept.select("page_id", F.length("html").alias("n_chars"))


@_query
def raw_normalize(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir)
    messy = {c: F.concat(F.lit(" \t"), F.upper(c), F.lit(" \n")) for c in RAW_COLUMNS}
    return _shown(clean.normalize_raw(raw.withColumns(messy)).drop("file_name"))


# Filters and scalar rules


@_query
def clean_listings(spark, sf_dir):
    return _shown(_cleaned(spark, sf_dir), *CLEAN_COLUMNS)


@_query
def price_contact_filter(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir)
    price = F.when(F.col("k") % 9 == 0, None).when(F.col("k") % 10 == 0, "CONTACT us")
    raw = raw.withColumn("House_Price", price.otherwise(F.col("House_Price")))
    return _shown(clean.without_contact_prices(raw), "k", "house_price")


def _priced(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir)
    once = clean.evaluate_once(
        raw, price_text=prices.price_text(F.col("House_Price"), F.col("House_Type"))
    )
    return once.select("k", prices.price_value(F.col("price_text")).alias("house_price"))


@_query
def price_clean(spark, sf_dir):
    return _priced(spark, sf_dir)


@_query
def price_floor(spark, sf_dir):
    return _priced(spark, sf_dir).filter(F.col("house_price") >= prices.PRICE_FLOOR)


@_query
def psf_value(spark, sf_dir):
    return _rule(spark, sf_dir, psf=prices.psf_value(F.col("Price_Square_Feet")))


@_query
def square_footage(spark, sf_dir):
    return _rule(spark, sf_dir, square_footage=prices.square_footage(F.col("Square_Footage")))


@_query
def not_null_gate(spark, sf_dir):
    return gate.rejected(_cleaned(spark, sf_dir)).select("property_id", "violation")


@_query
def not_null_pass(spark, sf_dir):
    return gate.passing(_cleaned(spark, sf_dir)).select("property_id", "posted_date")


@_query
def property_id(spark, sf_dir):
    return _rule(spark, sf_dir, property_id=links.property_id(F.col("Page_Link")))


@_query
def area(spark, sf_dir):
    return _rule(spark, sf_dir, area=links.area_slug(F.col("Page_Link")))


@_query
def posted_date(spark, sf_dir):
    return _rule(spark, sf_dir, posted_date=dates.posted_date(F.col("Posted_Date"), fx.AS_OF))


@_query
def capitalize(spark, sf_dir):
    columns = ("Agent_Name", "House_Name", "House_Location", "House_Type", "Lot_Type")
    return _rule(
        spark, sf_dir, **{c.lower(): text.capitalize_words(F.col(c)) for c in columns}
    )


@_query
def type_synonyms(spark, sf_dir):
    words = text.capitalize_words(F.col("House_Type"))
    return _rule(spark, sf_dir, house_type=text.expand_house_type(words))


@_query
def blank_nan(spark, sf_dir):
    return _rule(
        spark,
        sf_dir,
        agent_name=text.blank_nan(F.col("Agent_Name")),
        strict_agent_name=text.blank_nan(F.col("Agent_Name"), strict=True),
    )


@_query
def row_hash(spark, sf_dir):
    typed = fx.listings_typed(spark, sf_dir)
    return typed.select("property_id", hashing.row_hash(CLEAN_COLUMNS).alias("row_hash"))


# Star schema


@_query
def dim_state(spark, sf_dir):
    return star.dim_state(fx.listings_typed(spark, sf_dir)).select("state_name")


@_query
def dim_area(spark, sf_dir):
    current = fx.listings_typed(spark, sf_dir)
    dims = star.write_dimensions(
        spark, current, scratch_folder(spark, "star"), ["dim_state", "dim_area"]
    )
    return dims["dim_area"].join(dims["dim_state"], "state_id").select("area_name", "state_name")


@_query
def dim_property_type(spark, sf_dir):
    return star.dim_property_type(fx.listings_typed(spark, sf_dir)).select("property_type_name")


@_query
def dim_agent(spark, sf_dir):
    return star.dim_agent(fx.listings_typed(spark, sf_dir)).select("agent_name")


@_query
def dim_lot_type(spark, sf_dir):
    return star.dim_lot_type(fx.listings_typed(spark, sf_dir)).select("lot_type_name")


@_query
def dim_date(spark, sf_dir):
    return star.dim_date(fx.listings_typed(spark, sf_dir)).drop("date_id")


def _star(spark, sf_dir):
    """Current listings, dimensions and fact, each written once and read back."""
    folder = scratch_folder(spark, "star")
    fx.listings_typed(spark, sf_dir).write.parquet(f"{folder}/current")
    current = spark.read.parquet(f"{folder}/current")
    dims = star.write_dimensions(spark, current, folder, star.FACT_DIMENSIONS)
    star.sales_fact(current, dims).write.parquet(f"{folder}/fact")
    return current, dims, spark.read.parquet(f"{folder}/fact")


@_query
def fact_sales(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir)
    named = (
        fact.join(dims["dim_state"], "state_id")
        .join(dims["dim_area"].select("area_id", "area_name"), "area_id")
        .join(dims["dim_property_type"], "property_type_id")
        .join(dims["dim_agent"], "agent_id")
    )
    return _shown(
        named,
        "property_id",
        "state_name",
        "area_name",
        "property_type_name",
        "agent_name",
        "sale_date",
        "sale_price",
    )


@_query
def stable_ids(spark, sf_dir):
    """Agents after two runs: known names keep their ids, new names follow the highest."""
    current, folder = fx.listings_typed(spark, sf_dir), scratch_folder(spark, "star")
    early = F.regexp_extract("agent_name", r"(\d+)$", 1).cast("int") < 60
    star.write_dimensions(spark, current.filter(early), folder, ["dim_state", "dim_agent"])["dim_agent"].write.parquet(f"{folder}/first")
    first = spark.read.parquet(f"{folder}/first").select(F.col("agent_id").alias("first_id"), "agent_name")
    now = star.write_dimensions(spark, current, folder, ["dim_state", "dim_agent"])["dim_agent"]
    top = first.agg(F.max("first_id")).scalar()
    known = F.col("first_id").isNotNull()
    settled = F.when(known, F.col("agent_id") == F.col("first_id")).otherwise(F.col("agent_id") > top)
    return now.join(first, "agent_name", "left").select("agent_name", known.alias("known"), settled.alias("settled"))


# Marts


@_query
def incremental_marts(spark, sf_dir):
    """Three marts from the partials of three batches that insert, overwrite and move rows."""
    n_buckets = tables.buckets_for(spark, fx.listings_raw(spark, sf_dir))
    store, folder = tables.CurrentTable(spark, scratch_folder(spark, "current"), n_buckets=n_buckets), scratch_folder(spark, "partials")
    batches = (_visit(spark, sf_dir, 3, "a", "first agent", EARLY), fx.listings_raw(spark, sf_dir), _revisited(spark, sf_dir))
    for i, rows in enumerate(batches):
        staged = _cleaned_whole(rows)
        store.merge(gate.passing(staged), fx.AS_OF, False, f"b{i}")
        partials.write_partials(store.images(f"b{i}"), folder, f"b{i}")
    built = partials.read_marts(spark, folder)
    shown = {
        "avg_price_by_state": ("state", "average_price", "count"),
        "time_series_prices": ("period", "average_house_price", "count"),
        "agent_summary": ("agent_name", "average_sale_price", "properties_listed"),
    }
    out = None
    for name, (group, mean, count) in shown.items():
        rows = built[name].select(
            F.lit(name).alias("mart"), F.col(group).cast("string").alias("group_name"), F.round(mean, 4).alias("mean"), F.col(count).alias("n_listings")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@_query
def mart_state(spark, sf_dir):
    return marts.avg_price_by_state(_cleaned(spark, sf_dir))


@_query
def mart_time_series(spark, sf_dir):
    return marts.time_series_prices(fx.listings_typed(spark, sf_dir))


@_query
def mart_type_price(spark, sf_dir):
    return marts.price_trends_by_type(fx.listings_typed(spark, sf_dir))


@_query
def mart_type_dist(spark, sf_dir):
    return marts.property_type_distribution(fx.listings_typed(spark, sf_dir))


@_query
def mart_furniture(spark, sf_dir):
    return marts.furniture_status(fx.listings_typed(spark, sf_dir))


@_query
def mart_posting_dates(spark, sf_dir):
    return marts.posting_dates(fx.listings_typed(spark, sf_dir))


@_query
def mart_detail(spark, sf_dir):
    return marts.detailed_sales_summary(fx.listings_typed(spark, sf_dir))


@_query
def mart_agent(spark, sf_dir):
    _, dims, fact = _star(spark, sf_dir)
    return _shown(marts.agent_summary(fact, dims["dim_agent"]).drop("agent_id"))


@_query
def avg_count_full_outer(spark, sf_dir):
    raw = fx.listings_raw(spark, sf_dir).select(
        "k", "Agent_Name", prices.square_footage(F.col("Square_Footage")).alias("size")
    )
    return marts.averages_full_outer(
        raw.withColumnRenamed("Agent_Name", "agent_name"), "agent_name", "size", "k"
    )


@_query
def mv_snapshot(spark, sf_dir):
    current, dims, fact = _star(spark, sf_dir)
    built = marts.all_marts(current, fact, dims["dim_agent"])
    folder = scratch_folder(spark, "marts")
    tables.save_snapshots(built, folder)
    counted = {"detailed_sales_summary": "total_sales", "agent_summary": "properties_listed"}
    sizes = None
    for name in built:
        view = spark.read.parquet(f"{folder}/mv_{name}")
        size = view.agg(
            F.count("*").alias("n_groups"), F.sum(counted.get(name, "count")).alias("n_listings")
        ).select(F.lit(f"mv_{name}").alias("view_name"), "n_groups", "n_listings")
        sizes = size if sizes is None else sizes.unionByName(size)
    return sizes
