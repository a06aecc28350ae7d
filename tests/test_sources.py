"""Files and tables: reading, writing, first and later loads."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from helpers import NOON, clean_rows, listing, raw_rows
from lotmill import schemas
from lotmill.functions import links
from lotmill.operators.clean import clean_listings, judged_listings
from lotmill.operators.merge import insert_ignore, merge_if_newer, upsert_latest, with_versioning
from lotmill.plans import marts, partials, star
from lotmill.plans.refresh import refresh
from lotmill.session import drop_scratch, scratch_folder
from lotmill.sources import files, regions, tables

NAME = "batch1_03_johor_site_20240131_120000.csv"


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write(text)
    return path


def test_raw_folder_with_odd_files(spark, tmp_path):
    header = ",".join(schemas.RAW_COLUMNS) + "\n"
    cells = ["https://x.com/property/a/1", "x", '"two\nlines, ""quoted"""', "null", "rm 1", "n/a"]
    _write(tmp_path, NAME, header + ",".join(cells + ["none"] + [""] * 6) + "\n")
    _write(tmp_path, "batch1_04_penang_site_20240131_120000.csv", header)
    _write(tmp_path, "batch1_05_perak_site_20240131_120000.csv", "")
    files.write_header_only(spark, str(tmp_path / "batch1_06_kedah_site_20240131_120000.csv"))
    (row,) = files.read_raw(spark, str(tmp_path)).collect()
    assert row.Agent_Name == 'two\nlines, "quoted"'
    assert (row.Posted_Date, row.Price_Square_Feet, row.House_Name) == (None, None, "none")
    assert row.file_name.endswith(NAME)


def test_raw_round_trip_keeps_every_cell(spark, tmp_path):
    rows = raw_rows(spark, [{"Agent_Name": 'a "b"\nc, d\\', "House_Name": "\\"}], NAME)
    files.write_raw(rows, str(tmp_path / "raw"))
    back = files.read_raw(spark, str(tmp_path / "raw"))
    assert back.drop("file_name").collect() == rows.drop("file_name").collect()


def test_staging_is_not_written_when_empty(spark, tmp_path):
    path = str(tmp_path / "staging")
    assert not files.write_staging(clean_rows(spark, []), path)
    assert not os.path.exists(path)
    assert files.write_staging(clean_rows(spark, [listing("a")]), path)


def test_staging_csv_reads_only_staging_files(spark, tmp_path):
    rows = clean_rows(spark, [listing("a", agent_name="", posted_date=None), listing("b", 2)])
    files.write_staging(rows, str(tmp_path / "staging_data.csv"), "csv")
    files.write_staging(rows, str(tmp_path / "other.csv"), "csv")
    back = files.read_staging_csv(spark, str(tmp_path)).drop("file_name")
    assert sorted(back.collect()) == sorted(rows.collect(), key=lambda r: r.property_id)


def test_schema_dict_to_types():
    declared = json.loads('{"[a]": "NVARCHAR(MAX)", "b": "DECIMAL(20,2)", "c": "DATETIME", '
                          '"d": "DECIMAL", "e": "INT", "f": "BOOLEAN", "g": "DATE", "h": "DOUBLE"}')
    types = schemas.struct_from_types(declared)
    assert types.simpleString() == (
        "struct<a:string,b:decimal(20,2),c:timestamp_ntz,d:double,e:int,f:boolean,g:date,h:double>"
    )
    with pytest.raises(ValueError):
        schemas.struct_from_types({"a": "BLOB"})
    assert schemas.max_lengths(schemas.CLEAN_TYPES) == {
        "property_id": 50, "source": 9, "agent_name": 100, "state": 100, "area": 100
    }


def test_created_table_takes_a_bulk_copy_and_enforces_lengths(spark, tmp_path):
    spark.sql("drop table if exists listing_copy")
    schemas.create_table(spark, "listing_copy", schemas.CLEAN_TYPES)
    path = str(tmp_path / "staging_data.csv")
    files.write_staging(clean_rows(spark, [listing("a"), listing("b")]), path, "csv")
    files.copy_into(spark, path, "listing_copy")
    assert spark.table("listing_copy").columns == schemas.CURRENT_COLUMNS
    assert spark.table("listing_copy").filter("row_hash is null").count() == 2
    long = str(tmp_path / "long.csv")
    files.write_staging(clean_rows(spark, [listing("a", source="x" * 10)]), long, "csv")
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        files.copy_into(spark, long, "listing_copy")
    spark.sql("drop table listing_copy")


def test_archive_keeps_each_content_once(spark, tmp_path):
    archive = tables.raw_archive(spark, str(tmp_path / "a"), 4)
    batch = raw_rows(spark, [{"House_Name": "A "}, {"House_Name": "b"}, {"House_Name": None}, {"House_Name": ""}])
    assert tables.append_raw(archive, batch) == 4 and tables.append_raw(archive, batch) == 0
    files_before = sorted(os.listdir(tmp_path / "a"))
    more = raw_rows(spark, [{"House_Name": " B"}, {"House_Name": "c"}, {"House_Name": "c"}])
    assert tables.append_raw(archive, more.drop("Lot_Type")) == 1
    assert set(files_before) < set(os.listdir(tmp_path / "a"))
    assert sorted(str(r.House_Name) for r in archive.read().collect()) == ["", "None", "a", "b", "c"]


def test_current_table(spark, tmp_path):
    store = tables.CurrentTable(spark, str(tmp_path / "t"))
    assert store.read().isEmpty() and not store.exists()
    store.replace(with_versioning(clean_rows(spark, [listing("a")]), NOON))
    assert store.merge(clean_rows(spark, [listing("b"), listing("b")]), NOON) == {"inserted": 1, "updated": 1, "unchanged": 0}
    assert store.exists() and store.read().count() == 2
    assert store.merge(clean_rows(spark, []), NOON) == {"inserted": 0, "updated": 0, "unchanged": 0}
    with pytest.raises(RuntimeError):
        store.replace(store.read().limit(0))
    assert store.read().count() == 2
    store.replace(store.read().filter("property_id = 'b'"), "again")
    assert [r.property_id for r in store.read().collect()] == ["b"]
    assert [(r.action, r.before, r.after.property_id) for r in store.images("again").collect()] == [("insert", None, "b")]


def _partition_files(folder):
    return {d: sorted(os.listdir(os.path.join(folder, d))) for d in os.listdir(folder) if d.startswith("bucket=")}


def test_a_merge_leaves_other_buckets_alone(spark, tmp_path):
    store = tables.CurrentTable(spark, str(tmp_path / "t"), n_buckets=16)
    store.replace(with_versioning(clean_rows(spark, [listing(f"p{i}", i) for i in range(100)]), NOON))
    rows = tmp_path / "t" / "rows"
    before = _partition_files(rows)
    assert len(before) == 16
    batch = clean_rows(spark, [listing("p7", 5, day=9), listing("p7", 6, day=9), listing("p8", 8)])
    assert store.merge(batch, NOON, batch="x") == {"inserted": 0, "updated": 2, "unchanged": 1}
    after = _partition_files(rows)
    (moved,) = [b for b in before if before[b] != after[b]]
    prices = {r.property_id: int(r.house_price) for r in store.read().collect()}
    assert len(prices) == 100 and prices["p7"] == 6 and prices["p8"] == 8
    got = {r.property_id: (r.action, r.before and int(r.before.house_price), r.after and int(r.after.house_price)) for r in store.images("x").collect()}
    assert got == {"p7": ("update", 7, 6), "p8": ("unchanged", None, None)}
    # The same batch once more, under another name and under its own, writes no bucket.
    assert store.merge(batch, NOON, batch="y") == {"inserted": 0, "updated": 0, "unchanged": 3}
    assert _partition_files(rows) == after
    # Files of other buckets are not even opened.
    for b in before:
        if b != moved:
            for name in os.listdir(rows / b):
                os.truncate(rows / b / name, 0)
    assert store.merge(clean_rows(spark, [listing("p7", 7, day=10)]), NOON)["updated"] == 1


def test_a_merge_that_failed_before_its_write_is_run_again(spark, tmp_path, monkeypatch):
    store = tables.CurrentTable(spark, str(tmp_path / "t"))
    store.replace(with_versioning(clean_rows(spark, [listing("a", 1)]), NOON))
    batch = clean_rows(spark, [listing("a", 2, day=2), listing("b", 3)])
    with monkeypatch.context() as m:
        m.setattr(tables.CurrentTable, "_write", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.merge(batch, NOON, batch="x")
    assert store.merge(batch, NOON, batch="x") == {"inserted": 1, "updated": 1, "unchanged": 0}
    assert {r.property_id: int(r.house_price) for r in store.read().collect()} == {"a": 2, "b": 3}


def test_marts_of_three_batches_are_those_of_a_rebuild(spark, tmp_path):
    store, folder = tables.CurrentTable(spark, str(tmp_path / "t")), str(tmp_path / "p")
    batches = [
        [listing("a", 100), listing("b", 200, state=None), listing("c", 300, house_furniture=None)],
        [listing("a", 150, day=3, state="Perak"), listing("d", 50, posted_date=None), listing("c", 300, house_furniture=None)],
        [listing("b", 250, day=4, state="Perak", agent_name="Other"), listing("a", 10, day=2)],
    ]
    for i, rows in enumerate(batches):
        store.merge(clean_rows(spark, rows), NOON, True, f"b{i}")
        partials.write_partials(store.images(f"b{i}"), folder, f"b{i}")
    current = store.read()
    star_ = star.write_star(spark, current, str(tmp_path / "s"))
    expected = marts.all_marts(current, star_.fact, star_.dims["dim_agent"])
    got = partials.read_marts(spark, folder, star_.dims["dim_agent"])
    assert set(got) == set(expected)
    for name, mart in expected.items():
        columns = mart.columns
        assert sorted(map(str, got[name].select(*columns).collect())) == sorted(map(str, mart.collect())), name
    store.replace(current.filter("property_id = 'a'"), "whole")
    partials.start_partials(store.images("whole"), folder, "whole")
    (only,) = partials.read_marts(spark, folder)["avg_price_by_state"].collect()
    assert (only["state"], only["average_price"], only["count"]) == ("Johor", 150.0, 1)


def test_malformed_records_are_set_apart(spark, tmp_path):
    quoted = ['"https://x.com/property/a/%d"' % i for i in range(6)]
    tail = ',x,Ann,posted yesterday,%s,,"Name, one",Place,condominium,,,,2024-01-31 12:00:00'
    lines = [
        ",".join(schemas.RAW_COLUMNS),
        quoted[0] + tail % '"rm 500,000"',
        quoted[1] + tail % "rm 500,000",
        quoted[2] + ",x,Ann",
        quoted[3] + ',x,"Ann' + tail[6:] % '"rm 500,000"',
        quoted[4] + tail % '"rm 600,000"',
    ]
    _write(tmp_path, NAME, "\n".join(lines) + "\n")
    headers = files.file_headers(spark.read.schema("value string").text(str(tmp_path))).collect()
    rows, _ = files.read_files(spark, headers, multi_line=False)
    judged = {r.raw_line or r.property_id: r for r in judged_listings(rows, NOON).collect()}
    assert set(judged) == {"0", "4", *lines[2:5]}
    assert [judged[x].reject_reason for x in lines[2:5]] == ["cells"] * 3 and judged["0"].reject_reason is None
    # Counting, or asking for one column, cuts every record all the same.
    assert rows.filter("raw_line IS NOT NULL").count() == 3 and rows.select("raw_line").filter("raw_line IS NULL").count() == 2
    assert files.read_raw(spark, str(tmp_path), multi_line=False).count() == 2
    # With line breaks allowed a quote left open may take lines with it, but all of them stand in the reject.
    rows, _ = files.read_files(spark, headers)
    kept = {r.property_id for r in judged_listings(rows, NOON).filter("reject_reason IS NULL").collect()}
    broken = " ".join(r.raw_line for r in rows.filter("raw_line IS NOT NULL").collect())
    assert all(f"{i}" in kept or quoted[i] in broken for i in range(5))


def test_first_load_then_merge(spark, tmp_path):
    store = tables.CurrentTable(spark, str(tmp_path / "u"))
    tables.incremental_load(store, clean_rows(spark, [listing("a", 100, day=5)]), NOON)
    later = clean_rows(spark, [listing("a", 200, day=4), listing("b", 300), listing("c", posted_date=None)])
    got = {r.property_id: float(r.house_price) for r in tables.incremental_load(store, later, NOON).collect()}
    assert got == {"a": 100.0, "b": 300.0}
    # A load without any usable row fails, and what was there stays.
    with pytest.raises(RuntimeError):
        tables.full_reload(store, clean_rows(spark, [listing("a", posted_date=None)]), NOON)
    assert {r.property_id: float(r.house_price) for r in store.read().collect()} == got


@pytest.mark.parametrize("run", [upsert_latest, merge_if_newer])
@pytest.mark.parametrize("n_buckets, most_rows", [(4, 4), (None, 100)])
def test_a_merge_in_buckets_gives_the_rows_of_the_plain_one(spark, tmp_path, run, n_buckets, most_rows):
    """Keys that repeat or are null on either side, some with more rows than ``most_rows``, from files in a folder with a space."""
    stored = [listing(f"p{i}", i, day=5) for i in range(9)] + [listing("p1", 99, day=2), listing(None, 1), listing(None, 2)]
    batch = [listing(f"p{i % 12}", 100 + i % 7, day=1 + i % 9, created=1 + i % 4, house_name=f"n{i}") for i in range(30)]
    batch += [listing(key, i, created=3, agent_name=f"a{i}") for i in range(6) for key in ("p3", None)] + [listing("q", 1, posted_date=None)]
    folder = str(tmp_path / "two sides")
    with_versioning(clean_rows(spark, stored), datetime(2024, 1, 1)).write.parquet(f"{folder}/stored")
    clean_rows(spark, batch).repartition(3).write.parquet(f"{folder}/batch")
    existing, incoming = spark.read.parquet(f"{folder}/stored"), spark.read.parquet(f"{folder}/batch")
    expected = sorted(run(existing, incoming, NOON).collect(), key=str)
    found = tables.merged_in_buckets(run, existing, incoming, NOON, str(tmp_path / "merge"), n_buckets, most_rows)
    assert found.columns == schemas.CURRENT_COLUMNS and sorted(found.collect(), key=str) == expected
    cut = spark.read.parquet(str(tmp_path / "merge" / "batch")).filter("_cut")
    assert sorted((r.property_id for r in cut.collect()), key=str) == ([None, "p3"] if most_rows == 4 else [])
    none = tables.merged_in_buckets(run, existing, incoming.limit(0), NOON, str(tmp_path / "none"), n_buckets)
    assert sorted(none.collect(), key=str) == sorted(run(existing, incoming.limit(0), NOON).collect(), key=str)


def test_files_by_header_and_file_names(spark, tmp_path):
    columns = schemas.RAW_COLUMNS
    cells = {c: "" for c in columns} | {"Page_Link": "https://x.com/property/a/1", "Source": "x"}
    orders = {
        "batch1_06_negeri sembilan_site_20240131_120000.csv": columns[::-1],
        "batch1_01_a+b%20c_site_20240131_120000.csv": [c for c in columns if c != "Source"],
        "batch1_02_m\u00e9laka_site_20240131_120000.csv": ["Extra", *[c.lower() for c in columns]],
    }
    low = {c.lower(): v for c, v in cells.items()}
    for name, own in orders.items():
        _write(tmp_path, name, ",".join(own) + "\n" + ",".join(low.get(c.lower(), "z") for c in own) + "\n")
    _write(tmp_path, "other.csv", "a,b\n1,2\n")
    headers = files.file_headers(spark.read.schema("value string").text(str(tmp_path))).collect()
    rows, bad = files.read_files(spark, headers)
    got = {r.file_name.rsplit("/", 1)[1]: (r.Page_Link, r.Source) for r in rows.collect()}
    link = "https://x.com/property/a/1"
    assert got == dict(zip(orders, [(link, "x"), (link, None), (link, "x")]))
    (other,) = bad.collect()
    assert other.file_path.endswith("other.csv") and other.header == "a,b"
    states = rows.select(links.state_name(F.col("file_name")).alias("s")).collect()
    assert {r.s for r in states} == {"Negeri Sembilan", "A+b%20c", "M\u00e9laka"}
    files.write_raw(raw_rows(spark, [{}], next(iter(orders))), str(tmp_path / "again"))
    files.write_raw(raw_rows(spark, [{}], "batch1_01_a%2B+b_site_20240131_120000.csv"), str(tmp_path / "again"))
    names = {r.file_name for r in files.read_raw(spark, str(tmp_path / "again")).select("file_name").collect()}
    assert {n.rsplit("file_name=", 1)[1].split("/")[0] for n in names} == {next(iter(orders)), "batch1_01_a%2B+b_site_20240131_120000.csv"}


def test_copy_of_a_bad_value_is_an_error(spark, tmp_path):
    spark.sql("drop table if exists listing_copy2")
    schemas.create_table(spark, "listing_copy2", schemas.CLEAN_TYPES)
    rows = clean_rows(spark, [listing("a"), listing("b")]).withColumn("house_price", F.lit("many"))
    rows.write.options(**files.CSV).csv(str(tmp_path / "bad.csv"))
    with pytest.raises(Exception, match="house_price of row [ab] does not fit"):
        files.copy_into(spark, str(tmp_path / "bad.csv"), "listing_copy2")
    assert spark.table("listing_copy2").isEmpty()
    undated = clean_rows(spark, [listing("a", posted_date=None)])
    undated.write.options(**files.CSV).csv(str(tmp_path / "undated.csv"))
    with pytest.raises(Exception, match="posted_date is missing of row a"):
        files.copy_into(spark, str(tmp_path / "undated.csv"), "listing_copy2", not_null=True)
    files.copy_into(spark, str(tmp_path / "undated.csv"), "listing_copy2")
    assert spark.table("listing_copy2").count() == 1
    spark.sql("drop table listing_copy2")


def test_raw_table_keeps_the_first(spark, tmp_path):
    path = str(tmp_path / "raw")
    assert tables.load_raw_table(spark, clean_rows(spark, [listing("a", 1)]), path) == 1
    assert tables.load_raw_table(spark, clean_rows(spark, [listing("a", 2), listing("b", 3), listing("b", 4, created=2)]), path) == 1
    got = tables.raw_table(spark, path).read()
    assert {r.property_id: int(r.house_price) for r in got.collect()} == {"a": 1, "b": 3}
    assert insert_ignore(got, clean_rows(spark, [listing("a", 9)])).isEmpty()
    # A session that does not know the table yet finds its rows and buckets by the folder.
    spark.sql(f"drop table {tables.raw_table(spark, path).name}")
    assert tables.raw_table(spark, path).read().count() == 2
    assert tables.load_raw_table(spark, clean_rows(spark, [listing("a", 5), listing("c", 5)]), path) == 1


def test_region_lookup(spark):
    rows = regions.region_dim(spark).collect()
    assert len({r.region for r in rows}) == len({r.region_code for r in rows}) == 16
    assert {r.region: (r.script_number, r.region_code) for r in rows}["negeri-sembilan"] == ("06", "05")


class _Conf(dict):
    set = dict.__setitem__


class _Session:
    def __init__(self, master, **conf):
        self.conf = _Conf({k.replace("_", "."): v for k, v in conf.items()})
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "test"})()


def test_scratch_folder_is_the_cluster_setting():
    shared = _Session("yarn", spark_checkpoint_dir="hdfs:///shared")
    assert scratch_folder(shared, "x").startswith("hdfs:///shared/x-")
    with pytest.raises(RuntimeError):
        scratch_folder(_Session("yarn"), "x")
    local = _Session("local[2]")
    one, two = scratch_folder(local, "x"), scratch_folder(local, "x")
    assert one != two and os.path.dirname(one) == os.path.dirname(two)


def test_scratch_folders_are_dropped(spark):
    path = scratch_folder(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.exists(path)
    assert drop_scratch(spark) >= 1 and not os.path.exists(path)


def test_refresh_twice_gives_the_same_marts(spark, sf_dir, tmp_path):
    from lotmill import fixtures as fx

    raw, root = str(tmp_path / "raw"), str(tmp_path / "out")
    listings = fx.listings_raw(spark, sf_dir)
    files.write_raw(listings, raw)
    once = {n: sorted(m.collect(), key=str) for n, m in refresh(spark, raw, root, fx.AS_OF).items()}
    twice = {n: sorted(m.collect(), key=str) for n, m in refresh(spark, raw, root, fx.AS_OF).items()}
    assert once == twice and len(once) == 8
    current = tables.CurrentTable(spark, f"{root}/current_listings")
    assert len(os.listdir(f"{root}/current_listings/changes")) == 1  # the second run had no new file
    n = current.read().count()
    dated = clean_listings(listings, fx.AS_OF).filter(F.col("posted_date").isNotNull())
    assert n == dated.count() == spark.read.parquet(f"{root}/star/fact_property_sales").count()
    for name in ("avg_price_by_state", "posting_dates", "furniture_status", "time_series_prices"):
        assert sum(r["count"] for r in once[name]) == n
    undated = clean_listings(listings, fx.AS_OF).filter(F.col("posted_date").isNull()).count()
    turned_back = spark.read.parquet(f"{root}/rejected_listings")
    assert turned_back.filter("reason = 'null:posted_date'").count() == undated > 0
    assert current.read().filter(F.col("valid_from") != F.lit(datetime(2024, 1, 31, 12))).isEmpty()


def test_snapshot_tables_in_the_catalog(spark):
    spark.sql("create database if not exists olap")
    mart = spark.sql("select 'a' as state, 1 as count")
    tables.save_snapshot_tables({"one": mart}, "olap")
    tables.save_snapshot_tables({"one": mart.union(mart)}, "olap")
    assert spark.table("olap.mv_one").count() == 2
    spark.sql("drop database olap cascade")
