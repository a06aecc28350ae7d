"""DuckDB SQL that gives the same rows as each registered query."""

from __future__ import annotations

from lotmill.schemas import CLEAN_COLUMNS, RAW_COLUMNS

RAW = [c.lower() for c in RAW_COLUMNS]
AS_OF = "timestamp '2024-01-31 12:00:00'"
STORED_AT = "timestamp '2024-01-01 00:00:00'"

# Whitespace of the listing rules, spelled for RE2.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

WIDE = """
wide as (
  select *, o_orderkey as k
  from orders
  join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
)"""


def _whole(x: str) -> str:
    return f"format('{{:,}}', cast(floor({x}) as bigint))"


LISTINGS_RAW = (
    WIDE
    + f""",
listings_raw as (
  select k,
    case when k % 41 = 0 then null when k % 43 = 0 then ''
      else 'https://www.example.com.my/property/'
        || lower(replace(r_name || '-' || o_orderpriority, ' ', '-'))
        || '/sale-' || k || case when k % 2 = 0 then '/' else '' end end as page_link,
    'example' as source,
    case when k % 29 = 0 then null when k % 31 = 0 then 'nancy lim'
      else 'agent  no-' || (o_custkey % 97) end as agent_name,
    case k % 5 when 0 then 'posted today 09:30 am' when 1 then 'posted yesterday'
      when 2 then 'posted on ' || lower(strftime(o_orderdate, '%-d %b %Y'))
      when 3 then 'posted on ' || lower(strftime(o_orderdate, '%-d %b %Y')) || ' 02:15 pm'
      else 'unknown' end as posted_date,
    case when k % 17 = 0 then 'contact for price'
      when k % 13 = 0 then 'from rm ' || {_whole("o_totalprice")} || ' - rm '
        || {_whole("floor(o_totalprice) * 4")}
      when k % 11 = 0 then 'rm ' || {_whole("o_totalprice")} || ',000'
      when k % 7 = 0 then 'rm ' || {_whole("o_totalprice")} || '.50'
      when k % 10 = 3 then 'rm 150,000,' || lpad(cast(k % 1000 as varchar), 3, '0')
      when k % 10 = 7 then 'rm 1,234,' || lpad(cast(k % 1000 as varchar), 3, '0') || ',000'
      else 'rm ' || {_whole("o_totalprice")} end as house_price,
    case when k % 19 = 0 then null
      else 'rm ' || {_whole("o_totalprice / 10")} || '.50' end as price_square_feet,
    lower('residence ' || c_name) as house_name,
    lower(n_name || ', ' || r_name) as house_location,
    case c_mktsegment when 'BUILDING' then '2-sty terrace/link house'
      when 'AUTOMOBILE' then 'town homes' when 'MACHINERY' then case when k % 3 = 0 then 'Bungalow' else 'bungalow' end
      when 'HOUSEHOLD' then case when k % 3 = 0 then 'Residential Land' else 'residential land' end else 'condominium' end as house_type,
    case when k % 2 = 0 then 'corner  lot' else 'intermediate' end as lot_type,
    case k % 4 when 0 then 'from 1200 - 1500' when 1 then '1,350'
      when 2 then '900.5 sqft' end as square_footage,
    case o_orderstatus when 'F' then 'fully furnished' when 'P' then 'partly furnished'
      else 'unfurnished' end as house_furniture,
    '2024-01-31 12:00:00' as created_at,
    'batch1_01_' || lower(replace(n_name, '_', '-')) || '_listings_20240131_120000.csv' as file_name
  from wide
)"""
)

# Script number, region, region code.
REGIONS = """
  ('01', 'kuala-lumpur', '14'), ('02', 'selangor', '10'), ('03', 'johor', '01'),
  ('04', 'penang', '07'), ('05', 'perak', '08'), ('06', 'negeri-sembilan', '05'),
  ('07', 'melaka', '04'), ('08', 'pahang', '06'), ('09', 'sabah', '12'),
  ('10', 'sarawak', '13'), ('11', 'kedah', '02'), ('12', 'putrajaya', '16'),
  ('13', 'kelantan', '03'), ('14', 'terengganu', '11'), ('15', 'perlis', '09'),
  ('16', 'labuan', '15')"""

TYPED_COLUMNS = """
    cast(k as varchar) as property_id,
    'https://www.example.com.my/property/' || r_name || '-' || o_orderpriority || '/' || k as page_link,
    'example' as source,
    'Agent ' || (o_custkey % 97) as agent_name,
    n_name as state,
    r_name || '-' || o_orderpriority as area,
    cast(o_totalprice as decimal(20,2)) as house_price,
    cast(floor(o_totalprice) / 100 as decimal(20,2)) as price_square_feet,
    'Residence ' || c_name as house_name,
    n_name || ', ' || r_name as house_location,
    c_mktsegment as house_type,
    case when k % 2 = 0 then 'Corner Lot' else 'Intermediate' end as lot_type,
    cast(900 + k % 600 as decimal(20,2)) as square_footage,
    case o_orderstatus when 'F' then 'Fully Furnished' when 'P' then 'Partly Furnished'
      else 'Unfurnished' end as house_furniture,
    o_orderdate as posted_date,
    o_orderdate as created_at"""

LISTINGS_TYPED = WIDE + f",\nlistings_typed as (select {TYPED_COLUMNS} from wide)"

INCOMING = """
incoming as (
  select *, 'https://www.example.com.my/property/unit/' || property_id as page_link
  from (
    select
      cast(l_orderkey as varchar)
        || case when l_linenumber = 1 then '' else '-' || l_linenumber end as property_id,
      'example' as source,
      'Agent ' || (l_suppkey % 97) as agent_name,
      'STATE ' || l_returnflag as state,
      'AREA ' || (l_partkey % 50) as area,
      cast(l_extendedprice as decimal(20,2)) as house_price,
      cast(floor(l_extendedprice) / 100 as decimal(20,2)) as price_square_feet,
      'Unit ' || l_partkey as house_name,
      'Block ' || l_suppkey as house_location,
      'TYPE ' || l_linestatus as house_type,
      'LOT ' || l_linenumber as lot_type,
      cast(l_quantity * 10 as decimal(20,2)) as square_footage,
      'Unfurnished' as house_furniture,
      l_shipdate as posted_date,
      l_shipdate as created_at
    from lineitem
  )
)"""


def _hash(prefix: str = "") -> str:
    parts = (f"coalesce(cast({prefix}{c} as varchar), '')" for c in sorted(CLEAN_COLUMNS))
    return f"sha256({' || chr(124) || '.join(parts)})"


def _words(c: str) -> str:
    blank = f"trim(regexp_replace({c}, '[{SPACE}-]+', ' ', 'g'))"
    return (
        f"array_to_string(list_transform(string_split({blank}, ' '), "
        "lambda w: upper(w[1]) || lower(w[2:])), ' ')"
    )


def _no_nan(c: str) -> str:
    return f"case when lower(left({c}, 3)) = 'nan' then '' else coalesce({c}, '') end"


def _synonyms(c: str) -> str:
    for word, full in (("Homes", "House"), ("Sty", "Storey"), ("link", "Link")):
        c = rf"regexp_replace({c}, '\b{word}\b', '{full}', 'g')"
    return c


RAW_FILE = r"batch\d+_(\d+)_([^_/]+)_[^_/]+_\d+_\d+\.csv"
STATE = _words(f"nullif(regexp_extract(file_name, '{RAW_FILE}', 2), '')")
PROPERTY_ID = "regexp_extract(page_link, '([^/]+)/?$', 1)"
AREA = "regexp_extract(page_link, '/property/([^/]+)/', 1)"
SQUARE_FOOTAGE = (
    "try_cast(regexp_replace(split_part(replace(square_footage, 'from ', ''), ' - ', 1), "
    "'[^0-9.]+', '', 'g') as double)"
)
PSF = "try_cast(replace(replace(price_square_feet, 'rm ', ''), ',', '') as double)"
CLOCK = r"nullif(regexp_extract(posted_date, '(\d{2}:\d{2} [ap]m)', 1), '')"
ABSOLUTE = "trim(replace(posted_date, 'posted on ', ''))"
POSTED = f"""case
  when contains(posted_date, 'today')
    then try_strptime('2024-01-31 ' || {CLOCK}, '%Y-%m-%d %I:%M %p')
  when contains(posted_date, 'yesterday')
    then try_strptime('2024-01-30 ' || coalesce({CLOCK}, '12:00 am'), '%Y-%m-%d %I:%M %p')
  else coalesce(try_strptime({ABSOLUTE}, '%d %b %Y %I:%M %p'), try_strptime({ABSOLUTE}, '%d %b %Y'))
end"""


def _priced(source: str) -> str:
    """Step-by-step digit rules: the price of every row of ``source``."""
    def commas(p: str) -> str:
        return f"(length({p}) - length(replace({p}, ',', '')))"

    def digits(p: str) -> str:
        return f"regexp_replace({p}, '[^0-9]', '', 'g')"

    return f"""
price_0 as (
  select *, replace(replace(house_price, 'rm ', ''), 'from ', '') as p0 from {source}
),
price_1 as (
  select *, case when house_type in ('Residential Land', 'Bungalow') then p0
    when {commas("p0")} = 2 and length({digits("p0")}) = 9 and right({digits("p0")}, 3) <> '000'
      then regexp_replace(p0, ',000', ',0') else p0 end as p1 from price_0
),
price_2 as (
  select *, case when house_type in ('Residential Land', 'Bungalow') then p1
    when {commas("p1")} = 2 and length({digits("p1")}) = 9 and right({digits("p1")}, 3) = '000'
      then left(p1, length(p1) - 4) else p1 end as p2 from price_1
),
price_3 as (
  select *, case when house_type in ('Residential Land') then p2
    when {commas("p2")} >= 3 and length({digits("p2")}) >= 9 and right({digits("p2")}, 3) = '000'
      then left(p2, length(p2) - 4) else p2 end as p3 from price_2
),
price_4 as (select *, replace(p3, ',', '') as p4 from price_3),
priced as (
  select *, case
    when contains(p4, '-') and len(string_split(p4, '-')) = 2
      then (try_cast(split_part(p4, '-', 1) as double) + try_cast(split_part(p4, '-', 2) as double)) / 2
    when regexp_full_match(p4, '[0-9]+') then try_cast(p4 as double) end as price
  from price_4
)"""


LINKED = """
linked as (
  select * from {source}
  where page_link <> '' and not coalesce(contains(lower(house_price), 'contact'), false)
)"""

CLEANED = f"""
cleaned as (
  select
    {_no_nan(PROPERTY_ID)} as property_id,
    {_no_nan("page_link")} as page_link,
    {_no_nan("source")} as source,
    {_no_nan(_words("agent_name"))} as agent_name,
    {_no_nan(STATE)} as state,
    {_no_nan(_words(AREA))} as area,
    cast(price as decimal(20,2)) as house_price,
    cast(coalesce({PSF}, 0) as decimal(20,2)) as price_square_feet,
    {_no_nan(_words("house_name"))} as house_name,
    {_no_nan(_words("house_location"))} as house_location,
    {_no_nan(_synonyms(_words("house_type")))} as house_type,
    {_no_nan(_words("lot_type"))} as lot_type,
    cast(coalesce({SQUARE_FOOTAGE}, 0) as decimal(20,2)) as square_footage,
    {_no_nan(_words("house_furniture"))} as house_furniture,
    {POSTED} as posted_date,
    try_cast(created_at as timestamp) as created_at,
    file_name
  from priced where price >= 25000
)"""


def _clean_from(source: str) -> str:
    return ",".join([LINKED.format(source=source), _priced("linked"), CLEANED])


CLEAN = LISTINGS_RAW + "," + _clean_from("listings_raw")

LIMITS = {"property_id": 50, "source": 9, "agent_name": 100, "state": 100, "area": 100}
GATE = " and ".join(
    [f"{c} is not null" for c in CLEAN_COLUMNS] + [f"length({c}) <= {n}" for c, n in LIMITS.items()]
)

REVISITED = """
revisited as (
  select * replace (
    case when k % 2 = 1 and page_link <> '' then rtrim(page_link, '/') || '-b'
      else page_link end as page_link,
    'second agent' as agent_name,
    '2024-02-29 12:00:00' as created_at
  ) from listings_raw
)"""


BROKEN = """
broken as (
  select * replace (
    case when k % 23 = 0 then 'rm 100,000 - rm 200,000 - rm 300,000' else house_price end
      as house_price,
    case when k % 37 = 0 then 'ask agent' else price_square_feet end as price_square_feet,
    case when k % 53 = 0 then 'listings.csv' else file_name end as file_name
  ) from listings_raw
)"""

UNREADABLE = f"""case when len(string_split(p4, '-')) > 2 then 'price_range'
      when not price >= 25000 or price is null then null
      when file_name = 'listings.csv' then 'file_name'
      when price_square_feet is not null and {PSF} is null then 'price_square_feet' end"""


def _visit(n: int, suffix: str, agent: str, when: str) -> str:
    return f"""select * replace (
    case when k % {n} = 0 and page_link <> '' then rtrim(page_link, '/') || '-{suffix}'
      else page_link end as page_link,
    '{agent}' as agent_name, '{when}' as created_at
  ) from listings_raw"""


def _doubles(columns: list[str], prefix: str = "") -> str:
    decimals = ("house_price", "price_square_feet", "square_footage")
    return ", ".join(
        f"cast({prefix}{c} as double) as {c}" if c in decimals else f"{prefix}{c} as {c}"
        for c in columns
    )


def _ranked(direction: str, source: str = "incoming") -> str:
    first = ["created_at"] + (["file_name"] if source != "incoming" else [])
    rest = sorted(c for c in CLEAN_COLUMNS if c not in first)
    order = ", ".join(f"{c} {direction}" for c in [*first, *rest])
    return (
        f"select *, row_number() over (partition by property_id order by {order}) as rn "
        f"from (select *, {_hash()} as hashed from {source})"
    )


def _average(value: str, group: str) -> str:
    return f"cast(sum({value}) as double) / count({group})"


def _mart(select: str, group: str, ctes: str = LISTINGS_TYPED, source: str = "listings_typed") -> str:
    return f"with {ctes} select {select} from {source} group by {group}"


STAR = (
    LISTINGS_TYPED
    + """,
area_state as (
  select area, min(state) as state from listings_typed
  where area is not null and state is not null group by area
),
fact as (
  select property_id, state as state_name, area as area_name, house_type as property_type_name,
    agent_name, cast(posted_date as date) as sale_date, house_price as sale_price
  from listings_typed
  where state is not null and area is not null and house_type is not null and agent_name is not null
)"""
)

MERGED = (
    LISTINGS_TYPED
    + ","
    + INCOMING
    + f""",
latest as (select * from ({_ranked("desc")}) where rn = 1),
stored as (select *, {_hash()} as hashed from listings_typed)"""
)


def _merge(special: dict[str, str]) -> str:
    columns = []
    for c in CLEAN_COLUMNS:
        plain = f"case when i.property_id is not null then i.{c} else e.{c} end"
        value = special.get(c, plain)
        if c in ("house_price", "price_square_feet", "square_footage"):
            value = f"cast({value} as double)"
        columns.append(f"{value} as {c}")
    return f"""with {MERGED}
select {", ".join(columns)},
  case when i.property_id is not null then {AS_OF} else {STORED_AT} end as valid_from,
  true as is_current,
  case when i.property_id is not null then i.hashed else e.hashed end as row_hash
from stored e full outer join latest i on e.property_id = i.property_id"""


def _names(column: str, name: str) -> str:
    return (
        f"with {LISTINGS_TYPED} select distinct {column} as {name} from listings_typed "
        f"where {column} is not null"
    )


AREA_TEXT = "regexp_extract(house_price, 'rm ([0-9,]+)', 1)"
ATTR_FIELDS = f"""
  house_type,
  lot_type,
  nullif(replace({AREA_TEXT}, ',', ''), '') as square_footage,
  house_furniture"""


def _build() -> dict[str, str]:
    raw = ", ".join(RAW)
    lowered = raw.replace("house_type", "lower(house_type) as house_type")
    sql: dict[str, str] = {}
    sql["raw_scan"] = f"""with {LISTINGS_RAW}
select {", ".join(f"nullif({c}, '') as {c}" for c in RAW)},
  regexp_extract(file_name, '{RAW_FILE}', 2) as region from listings_raw"""
    sql["null_tokens"] = f"""with {LISTINGS_RAW}
select k, nullif(page_link, '') as page_link, agent_name,
  case k % 7 when 0 then null when 1 then null when 2 then null when 3 then null
    when 4 then 'none' else house_name end as house_name,
  square_footage
from listings_raw"""
    sql["quarantine"] = f"""with {LISTINGS_RAW},{BROKEN},{LINKED.format(source="broken")},{_priced("linked")},
judged as (select {_no_nan(PROPERTY_ID)} as property_id, {UNREADABLE} as reject_reason from priced)
select * from judged where reject_reason is not null"""
    sql["insert_ignore"] = f"""with {LISTINGS_TYPED},{INCOMING}
select {_doubles(CLEAN_COLUMNS)} from ({_ranked("asc")})
where rn = 1 and property_id not in (select property_id from listings_typed)"""
    sql["upsert_latest"] = _merge({})
    sql["merge_if_newer"] = _merge(
        {
            "house_price": """case when e.property_id is null then i.house_price
  when i.posted_date > e.posted_date and i.house_price <> e.house_price then i.house_price
  else e.house_price end""",
            "posted_date": """case when e.property_id is null then i.posted_date
  when i.posted_date > e.posted_date then i.posted_date else e.posted_date end""",
        }
    )
    sql["merge_counts"] = f"""with {LISTINGS_TYPED},{INCOMING},
keyed as (
  select i.property_id, e.property_id is null as is_new, count(*) as n
  from incoming i left join listings_typed e on i.property_id = e.property_id group by 1, 2
)
select 'inserted' as action, cast(count(*) filter (is_new) as bigint) as n_rows from keyed
union all
select 'updated', cast(sum(n) - count(*) filter (is_new) as bigint) from keyed"""
    sql["full_reload"] = f"""with {CLEAN}
select {_doubles(CLEAN_COLUMNS)}, {AS_OF} as valid_from, true as is_current, {_hash()} as row_hash
from cleaned where {GATE}"""
    sql["append_dedup"] = f"""with {LISTINGS_RAW},{REVISITED}
select distinct {lowered} from (
  select {raw} from listings_raw
  union all
  select {raw} from (select * replace (null as square_footage) from revisited)
)"""
    sql["append_fingerprint"] = sql["append_dedup"]
    quoted = {c: f"""'"' || replace(coalesce({c}, ''), '"', '""') || '"'""" for c in RAW}
    priced = " || ',' || ".join("'rm 500,000'" if c == "house_price" else quoted[c] for c in RAW)
    cut = " || ',' || ".join(quoted[c] for c in RAW[:3])
    opened = " || ',' || ".join(f"""rtrim({quoted[c]}, '"')""" if c == "house_name" else quoted[c] for c in RAW)
    sql["malformed_rows"] = f"""with {LISTINGS_RAW}
select 'cells' as reason, case when k % 19 = 0 then {priced} when k % 23 = 0 then {cut} else {opened} end as raw_line
from listings_raw where k % 19 = 0 or k % 23 = 0 or k % 29 = 0"""
    sql["redelivered_batch"] = """with acts as (
  select 'first' as delivery, case when o_orderkey % 3 = 0 then 'insert' when o_orderkey % 10 = 0 then 'update' else 'unchanged' end as action
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
  union all
  select 'again', 'unchanged' from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
)
select delivery, action, count(*) as n_rows from acts group by all"""
    sql["bulk_copy"] = f"""with {CLEAN}
select {_doubles(CLEAN_COLUMNS)} from cleaned where {GATE}"""
    sql["visited_once"] = """select url, cast(min(case when page_id % 3 <> 0 then 1 else 2 end) as int) as run
from pages group by url"""
    sql["stable_ids"] = """select 'Agent ' || a as agent_name, a < 60 as known, true as settled
from (select distinct o_custkey % 97 as a from orders join customer on o_custkey = c_custkey)"""
    sql["incremental_marts"] = f"""with {LISTINGS_RAW},{REVISITED},
visits as (
  select * from listings_raw union all select * from revisited
  union all {_visit(3, "a", "first agent", "2023-12-31 12:00:00")}
),
{_clean_from("visits").lstrip()},
latest as (select * from ({_ranked("desc", "(select * from cleaned where " + GATE + ")")}) where rn = 1),
groups as (
  select 'avg_price_by_state' as mart, state as group_name, house_price from latest
  union all select 'time_series_prices', cast(cast(date_trunc('month', posted_date) as date) as varchar), house_price from latest
  union all select 'agent_summary', agent_name, house_price from latest
)
select mart, group_name, round(cast(sum(house_price) as double) / count(*), 4) as mean, count(*) as n_listings
from groups group by all"""
    sql["state_from_file"] = f"with {LISTINGS_RAW} select k, {STATE} as state from listings_raw"
    sql["schema_from_json"] = f"""with {LISTINGS_TYPED}
select {_doubles(CLEAN_COLUMNS)} from (
  select * replace (case when lot_type = 'Corner Lot' then null else house_price end as house_price)
  from listings_typed
)"""
    sql["region_dim"] = f"""with {LISTINGS_RAW},
regions(script_number, region, region_code) as (values {REGIONS}),
numbered as (
  select lpad(cast(cast(regexp_extract(file_name, 'nation-(\\d+)', 1) as int) % 16 + 1 as varchar),
    2, '0') as script_number
  from listings_raw
)
select script_number, region, region_code, count(*) as n_listings
from numbered join regions using (script_number) group by all"""
    sql["ingest_rejects"] = f"""with {LISTINGS_RAW},{BROKEN},{LINKED.format(source="broken")},{_priced("linked")},
judged as (select {_no_nan(PROPERTY_ID)} as property_id, {UNREADABLE} as reason, price, {POSTED} as posted from priced)
select property_id, coalesce(reason, 'null:posted_date') as reason from judged
where reason is not null or (price >= 25000 and posted is null)"""
    sql["files_by_header"] = f"""with {LISTINGS_RAW}
select {", ".join(
        f"case when k % 3 = 1 then null else nullif({c}, '') end as {c}" if c in ("square_footage", "house_furniture")
        else f"nullif({c}, '') as {c}" for c in RAW)} from listings_raw"""
    sql["stream_ingest"] = f"""with {LISTINGS_RAW},{REVISITED},
visits as (
  select * from listings_raw union all select * from revisited
  union all {_visit(3, "a", "first agent", "2023-12-31 12:00:00")}
  union all {_visit(5, "c", "third agent", "2024-02-15 12:00:00")}
),
{_clean_from("visits").lstrip()},
latest as (select * from ({_ranked("desc", "(select * from cleaned where " + GATE + ")")}) where rn = 1)
select {_doubles(CLEAN_COLUMNS)}, {AS_OF} as valid_from, true as is_current, hashed as row_hash
from latest"""
    # Pages hold 20 listings and are visited twice; the first visit that is no challenge
    # counts, and so does each without a URL. Rendered text collapses blanks, and an
    # empty address is that of the page.
    sql["listings_from_html"] = f"""with {LISTINGS_RAW},
seen as (
  select *, cast(floor(k / 20) as bigint) as page_no, unnest([0, 1]) as visit from listings_raw
),
kept as (
  select *, case when page_no % 7 = 0 and visit = 1 then null
    else 'https://www.example.com.my/sale?page=' || page_no end as url
  from seen where (visit = 0 and page_no % 5 <> 0) or (visit = 1 and (page_no % 5 = 0 or page_no % 7 = 0))
)
-- A card with an empty address on a page without one has no readable source.
select page_no * 2 + visit as page_id, cast(k % 20 as int) as card_no,
  case when page_link = '' then coalesce(url, '') else page_link end as page_link,
  case when page_link is null then null when page_link = '' and url is null then null else source end as source,
  regexp_replace(agent_name, ' +', ' ', 'g') as agent_name,
  posted_date, house_price, price_square_feet, house_name, house_location,
  lower(house_type) as house_type, regexp_replace(lot_type, ' +', ' ', 'g') as lot_type,
  nullif(replace({AREA_TEXT}, ',', ''), '') as square_footage, house_furniture, created_at
from kept where page_link is null or page_link <> '' or url is not null"""
    sql["rejected_cards"] = f"""with {LISTINGS_RAW},
seen as (
  select *, cast(floor(k / 20) as bigint) as page_no, unnest([0, 1]) as visit from listings_raw
)
select page_no * 2 + visit as page_id, cast(k % 20 as int) as card_no, 'source' as reject_reason
from seen where page_link = '' and page_no % 7 = 0 and visit = 1"""
    sql["source_from_url"] = """
select page_id, nullif(split_part(split_part(url, '/', 3), '.', 2), '') as source from pages"""
    sql["psf_text"] = f"""with {LISTINGS_RAW}
select k, case when k % 9 = 0 then null else price_square_feet end as psf from listings_raw"""
    sql["attr_text"] = f"with {LISTINGS_RAW} select k, {ATTR_FIELDS} from listings_raw"
    sql["page_dedup"] = """
select page_id * 2 as page_id, url, cast(length(html) as int) as n_chars
from (select min(page_id) as page_id, url from pages group by url) join pages using (page_id, url)"""
    sql["page_filter"] = """
select page_id, cast(length(html) as int) as n_chars
from (
  select page_id,
    case when page_id % 7 = 0 then html || '<p>Checking your browser</p>' else html end as html
  from pages
) where html not like '%Checking your browser%'"""
    sql["raw_normalize"] = f"with {LISTINGS_RAW} select k, {lowered} from listings_raw"
    sql["clean_listings"] = f"with {CLEAN} select {_doubles(CLEAN_COLUMNS)} from cleaned"
    sql["price_contact_filter"] = f"""with {LISTINGS_RAW}
select * from (
  select k, case when k % 9 = 0 then null when k % 10 = 0 then 'CONTACT us' else house_price end
    as house_price from listings_raw
) where house_price is null or house_price not ilike '%contact%'"""
    sql["price_clean"] = (
        f"with {LISTINGS_RAW},{_priced('listings_raw')} select k, price as house_price from priced"
    )
    sql["price_floor"] = sql["price_clean"] + " where price >= 25000"
    sql["psf_value"] = f"with {LISTINGS_RAW} select k, {PSF} as psf from listings_raw"
    sql["square_footage"] = (
        f"with {LISTINGS_RAW} select k, {SQUARE_FOOTAGE} as square_footage from listings_raw"
    )
    sql["not_null_gate"] = f"""with {CLEAN}
select property_id, 'null:posted_date' as violation from cleaned where posted_date is null"""
    sql["not_null_pass"] = (
        f"with {CLEAN} select property_id, posted_date from cleaned where {GATE}"
    )
    sql["property_id"] = (
        f"with {LISTINGS_RAW} select k, {PROPERTY_ID} as property_id from listings_raw"
    )
    sql["area"] = f"with {LISTINGS_RAW} select k, {AREA} as area from listings_raw"
    sql["posted_date"] = (
        f"with {LISTINGS_RAW} select k, {POSTED} as posted_date from listings_raw"
    )
    capitalized = ("agent_name", "house_name", "house_location", "house_type", "lot_type")
    sql["capitalize"] = (
        f"with {LISTINGS_RAW} select k, "
        + ", ".join(f"{_words(c)} as {c}" for c in capitalized)
        + " from listings_raw"
    )
    sql["type_synonyms"] = (
        f"with {LISTINGS_RAW} select k, {_synonyms(_words('house_type'))} as house_type "
        "from listings_raw"
    )
    sql["blank_nan"] = f"""with {LISTINGS_RAW}
select k, {_no_nan("agent_name")} as agent_name, coalesce(agent_name, '') as strict_agent_name
from listings_raw"""
    sql["row_hash"] = (
        f"with {LISTINGS_TYPED} select property_id, {_hash()} as row_hash from listings_typed"
    )
    sql["dim_state"] = _names("state", "state_name")
    sql["dim_property_type"] = _names("house_type", "property_type_name")
    sql["dim_agent"] = _names("agent_name", "agent_name")
    sql["dim_lot_type"] = _names("lot_type", "lot_type_name")
    sql["dim_area"] = (
        f"with {STAR} select area as area_name, state as state_name from area_state"
    )
    sql["dim_date"] = f"""with {LISTINGS_TYPED}
select distinct cast(posted_date as date) as date, cast(day(posted_date) as int) as day,
  cast(month(posted_date) as int) as month, cast(year(posted_date) as int) as year,
  cast(quarter(posted_date) as int) as quarter,
  cast(dayofweek(posted_date) as int) as day_of_week,
  cast(weekofyear(posted_date) as int) as week_of_year
from listings_typed where posted_date is not null"""
    sql["fact_sales"] = f"""with {STAR}
select * replace (cast(sale_price as double) as sale_price) from fact"""
    by_price = f"{_average('house_price', 'house_price')}"
    sql["mart_state"] = _mart(
        f"state, {by_price} as average_price, count(property_id) as count", "state", CLEAN, "cleaned"
    )
    sql["mart_time_series"] = _mart(
        f"cast(date_trunc('month', posted_date) as date) as period, {by_price} as "
        "average_house_price, count(property_id) as count",
        "1",
    )
    sql["mart_type_price"] = _mart(
        f"house_type as property_type, {by_price} as average_price, count(property_id) as count", "1"
    )
    sql["mart_type_dist"] = _mart("house_type as property_type, count(*) as count", "1")
    sql["mart_furniture"] = _mart("house_furniture as furniture_status, count(*) as count", "1")
    sql["mart_posting_dates"] = _mart(
        "cast(posted_date as date) as posting_date, count(*) as count", "1"
    )
    detail = f"""with {STAR}
select cast(posted_date as date) as posted_date, house_type as property_type, state, agent_name,
  area, {by_price} as average_price, count(property_id) as total_sales
from listings_typed
where house_type is not null and state is not null and agent_name is not null and area is not null
group by listings_typed.posted_date, house_type, state, agent_name, area"""
    sql["mart_detail"] = detail
    agent = f"""with {STAR}
select agent_name, cast(sum(sale_price) as double) as total_sales,
  {_average("sale_price", "sale_price")} as average_sale_price,
  count(property_id) as properties_listed
from fact group by agent_name"""
    sql["mart_agent"] = agent
    sql["avg_count_full_outer"] = f"""with {LISTINGS_RAW},
sized as (select k, agent_name, {SQUARE_FOOTAGE} as size from listings_raw),
a as (select agent_name, sum(size) / count(size) as average from sized group by agent_name),
c as (select agent_name as count_key, count(k) as count from sized group by agent_name)
select agent_name, average, count from a full outer join c on agent_name = count_key"""
    views = {
        "time_series_prices": (sql["mart_time_series"], "count"),
        "furniture_status": (sql["mart_furniture"], "count"),
        "avg_price_by_state": (_mart("state, count(property_id) as count", "1"), "count"),
        "price_trends_by_type": (sql["mart_type_price"], "count"),
        "property_type_distribution": (sql["mart_type_dist"], "count"),
        "posting_dates": (sql["mart_posting_dates"], "count"),
        "detailed_sales_summary": (detail, "total_sales"),
        "agent_summary": (agent, "properties_listed"),
    }
    sql["mv_snapshot"] = "\nunion all\n".join(
        f"select 'mv_{name}' as view_name, count(*) as n_groups, "
        f"cast(sum({measure}) as bigint) as n_listings from ({body})"
        for name, (body, measure) in views.items()
    )
    return sql


ORACLE = _build()
