"""Physical plans: shuffles, pruning and code size that scale depends on."""

import re

import pytest
from pyspark.sql import functions as F

from helpers import NOON, physical_plan
from lotmill import fixtures as fx
from lotmill.operators import dedup, merge
from lotmill.operators.cards import extract_listings
from lotmill.operators.clean import clean_listings
from lotmill.plans import marts, partials, star
from lotmill.queries import QUERIES
from lotmill.schemas import RAW_COLUMNS
from lotmill.sources import files, tables
from lotmill.sources.tables import BucketedTable, CurrentTable, append_raw, raw_archive, raw_table


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Current, incoming and raw listings as parquet, joined without broadcast."""
    folder = str(tmp_path_factory.mktemp("plans"))
    from conftest import SF_DIR

    fx.listings_current(spark, SF_DIR).write.parquet(f"{folder}/current")
    fx.listings_incoming(spark, SF_DIR).write.parquet(f"{folder}/incoming")
    fx.listings_raw(spark, SF_DIR).write.parquet(f"{folder}/raw")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield lambda name: spark.read.parquet(f"{folder}/{name}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def _count(plan: str, node: str) -> int:
    return len(re.findall(rf"[-+ ] {node}\b", plan))


def test_one_row_per_key_is_settled_before_the_shuffle(stored):
    plan = physical_plan(dedup.keep_last(stored("incoming"), "property_id"))
    assert _count(plan, "Exchange") == 1
    final, partial = plan.split("Exchange", 1)
    assert "WindowGroupLimit" in partial


def test_upsert_shuffles_each_side_once(stored):
    plan = physical_plan(merge.upsert_latest(stored("current"), stored("incoming"), NOON))
    assert _count(plan, "Exchange") == 2 and "SortMergeJoin" in plan


@pytest.mark.parametrize("query", ["upsert_latest", "merge_if_newer"])
def test_the_rows_of_a_merge_are_not_shuffled(spark, stored, sf_dir, monkeypatch, query):
    monkeypatch.setattr(tables, "BUCKET_BYTES", 1)
    plan = physical_plan(QUERIES[query](spark, sf_dir))
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    buckets = spark.conf.get("spark.sql.shuffle.partitions")
    assert plan.count(f"SelectedBucketsCount: {buckets} out of {buckets}") == 2


def test_stored_keys_and_fingerprints_are_not_shuffled(spark, stored, tmp_path):
    table = raw_table(spark, str(tmp_path / "raw"), 16)
    table.append(dedup.keep_first(stored("current"), "property_id"))
    archive = raw_archive(spark, str(tmp_path / "archive"), 16)
    append_raw(archive, stored("raw"))
    new = dedup.fingerprinted(stored("raw")).dropDuplicates(["fingerprint"])
    for plan, key in ((physical_plan(table.unseen(stored("incoming"))), "property_id"), (physical_plan(archive.unseen(new)), "fingerprint")):
        batch, old = plan.split("Exchange", 1)[1], plan.rsplit("FileScan", 1)
        assert "Bucketed: true" in old[1] and f"ReadSchema: struct<{key}:string>" in old[1]
        assert "Exchange" not in old[0].rsplit("+- ", 3)[1] and "Bucketed: true" not in batch.split("FileScan")[1]


def test_marts_of_a_batch_read_no_stored_rows(spark, stored, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "t"), n_buckets=8)
    table.merge(stored("current"), NOON, batch="one")
    partials.write_partials(table.images("one"), str(tmp_path / "p"), "one")
    plan = physical_plan(partials.partials(partials.signed_rows(table.images("one"))))
    assert plan.count("FileScan") == plan.count("before:struct<") > 0 and "/rows" not in plan
    for mart in partials.read_marts(spark, str(tmp_path / "p")).values():
        assert "/rows" not in physical_plan(mart)
    plan = physical_plan(table._rows([3]))
    assert re.search(r"PartitionFilters: \[.*bucket#\d+ (IN \(3\)|= 3)", plan)


def test_a_batch_is_shuffled_once_and_stored_rows_never(spark, stored, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "t"), n_buckets=8)
    table.replace(merge.latest_rows(table.dealt(stored("current").drop("valid_from", "valid_to", "is_current", "row_hash")), NOON), "one", dealt=True)
    batch = merge.counted_latest(table.dealt(stored("incoming")), NOON).withColumn("bucket", table.bucket())
    assert physical_plan(batch).count("Exchange") == 1
    cut = BucketedTable(spark, str(tmp_path / "cut"), batch.schema, "property_id", 8)
    cut.overwrite(batch)
    images = merge.change_images(table._rows(), cut.read())
    kept = table._rows([1, 2]).join(table._changes("one").read().select("property_id"), "property_id", "left_anti")
    for plan in (physical_plan(images), physical_plan(kept)):
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    # A bucket's rows are in one file, the one that Spark puts their key into.
    for folder in (tmp_path / "t" / "rows").glob("bucket=*"):
        (file,) = folder.glob("*.parquet")
        assert int(file.name.split("_")[1].split(".")[0]) == int(folder.name.split("=")[1])


def test_insert_reads_only_stored_keys(stored):
    plan = physical_plan(merge.insert_ignore(stored("current"), stored("incoming")))
    assert "ReadSchema: struct<property_id:string>" in plan


@pytest.mark.parametrize(
    "mart, columns",
    [
        (marts.avg_price_by_state, {"property_id", "state", "house_price"}),
        (marts.furniture_status, {"house_furniture"}),
        (marts.posting_dates, {"posted_date"}),
    ],
)
def test_marts_read_their_columns_in_one_scan(stored, mart, columns):
    plan = physical_plan(mart(stored("current")))
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$)", plan)
    assert set(re.findall(r"(\w+):", schema)) == columns
    assert _count(plan, "Exchange") == 1 and plan.count("HashAggregate") == 2


def test_agent_sums_come_before_the_join(spark, stored, tmp_path):
    built = star.write_star(spark, stored("current"), str(tmp_path))
    plan = physical_plan(marts.agent_summary(built.fact, built.dims["dim_agent"]))
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate")


def test_fact_broadcasts_only_files_below_the_threshold(spark, stored, tmp_path):
    dims = star.write_dimensions(spark, stored("current"), str(tmp_path), star.FACT_DIMENSIONS)
    assert "BroadcastHashJoin" not in physical_plan(star.sales_fact(stored("current"), dims))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        plan = physical_plan(star.sales_fact(stored("current"), dims))
        assert _count(plan, "BroadcastHashJoin") == 4 and "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_numbering_has_no_global_sort(stored):
    plan = physical_plan(star.dim_agent(stored("current")))
    # The one single-partition step sums at most 256 bucket sizes.
    before_sizes = plan.split("BroadcastExchange")[0]
    assert "SinglePartition" not in before_sizes
    # Both passes over the names share one scan.
    stored_names = star.dim_agent(stored("current"))
    stored_names.collect()
    assert "ReusedExchange" in physical_plan(stored_names)


def test_cleaning_is_one_pass_that_the_jvm_compiles(stored):
    cleaned = clean_listings(stored("raw"), NOON)
    plan = physical_plan(cleaned)
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("Generate inline") == 2
    stages = cleaned._jdf.queryExecution().debug().codegenToSeq().iterator()
    while stages.hasNext():
        assert stages.next()._3().maxMethodCodeSize() < 8000


def test_cleaning_prunes_what_a_mart_does_not_need(stored):
    plan = physical_plan(marts.avg_price_by_state(clean_listings(stored("raw"), NOON)))
    (columns,) = re.findall(r"FileScan parquet \[(.*?)\]", plan)
    assert set(re.findall(r"(\w+)#", columns)) == {
        "Page_Link",
        "House_Price",
        "Price_Square_Feet",
        "House_Type",
        "file_name",
    }


def test_page_bodies_are_not_shuffled(spark, sf_dir, stored):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    plan = physical_plan(extract_listings(pages, NOON))
    assert plan.count("MapInPandas") == 1
    for own in (plan, physical_plan(QUERIES["page_dedup"](spark, sf_dir))):
        for part in own.split("Exchange")[1:]:
            columns = part.split("\n")[1]
            assert "html" not in columns


def test_a_large_batch_meets_the_stored_rows_in_one_join_and_is_written_unsorted(spark, stored, tmp_path):
    table = CurrentTable(spark, str(tmp_path / "t"), n_buckets=8)
    table.merge(stored("current"), NOON, batch="one")
    latest = merge.counted_latest(table.dealt(stored("incoming")), NOON).withColumn("bucket", table.bucket())
    cut = BucketedTable(spark, str(tmp_path / "cut"), latest.schema, "property_id", 8)
    cut.overwrite(latest)
    images = merge.change_images(table._rows(), cut.read(), small=False)
    images.createOrReplaceTempView("images_of_a_batch")
    rewritten = table._changes("one").read().select("property_id", "after")
    with tables._bucket_a_task(spark):
        plan = spark.sql(f"EXPLAIN INSERT OVERWRITE TABLE {table._changes('two').name} SELECT * FROM images_of_a_batch").first()[0]
        assert "SelectedBucketsCount: 8 out of 8" in physical_plan(rewritten)
    # Two sorts, for the join, and none of the images; nothing is left of the settings.
    assert _count(plan, "SortMergeJoin") == 1 and _count(plan, "Sort") == 2 and "Exchange" not in plan
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    assert spark.conf.get("spark.sql.sources.bucketing.autoBucketedScan.enabled") == "true"


def test_keys_that_are_many_are_not_broadcast(spark, stored, tmp_path, monkeypatch):
    seen, threshold = [], spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    table = CurrentTable(spark, str(tmp_path / "t"), n_buckets=8)
    table.merge(stored("current"), NOON, batch="one")
    monkeypatch.setattr(CurrentTable, "_write", lambda self, rows: seen.append(physical_plan(rows)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        for few in (10**6, 1):
            monkeypatch.setattr(tables, "FEW_KEYS", few)
            table.merge(stored("incoming"), NOON, False, f"few {few}")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "BroadcastHashJoin" in seen[0] and "BroadcastHashJoin" not in seen[1] and "SortMergeJoin" in seen[1]


def test_stored_keys_are_not_broadcast_for_small_files(spark, stored, tmp_path):
    table, threshold = raw_table(spark, str(tmp_path / "raw"), 8), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    table.append(dedup.keep_first(stored("current").repartition(8, "property_id"), "property_id"), dealt=True)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        first = dedup.keep_first(table.dealt(stored("incoming")), "property_id")
        plan = physical_plan(table.unseen(first, dealt=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    # New rows are sorted once, as they are cut; of the stored rows only keys are.
    assert "Broadcast" not in plan and _count(plan, "SortMergeJoin") == 1 and _count(plan, "Sort") == 2


@pytest.mark.parametrize("query", ["stream_ingest", "incremental_marts"])
def test_buckets_grow_with_the_files(spark, sf_dir, monkeypatch, query):
    raw, made = fx.listings_raw(spark, sf_dir), []
    assert tables.buckets_for(spark, raw) == tables.BUCKETS
    monkeypatch.setattr(tables, "BUCKET_BYTES", tables.bytes_read(spark, raw) // 40 + 1)
    monkeypatch.setattr(CurrentTable, "replace", lambda self, *a, **b: made.append(self.n_buckets))
    monkeypatch.setattr(CurrentTable, "merge", lambda self, *a, **b: made.append(self.n_buckets) or 1 / 0)
    with pytest.raises(Exception):
        QUERIES[query](spark, sf_dir)
    assert set(made) == {tables.buckets_for(spark, raw)} and made[0] > tables.BUCKETS


def test_no_rows_need_no_python(spark, tmp_path):
    empty = CurrentTable(spark, str(tmp_path / "t"))
    for rows in (empty.read(), empty._rows(), files.empty_raw(spark), files.read_files(spark, [])[1]):
        assert "ExistingRDD" not in physical_plan(rows) and rows.isEmpty()
    assert empty.read().schema.names == empty.schema.names


def test_a_small_batch_goes_to_the_stored_rows(spark, stored, tmp_path):
    batch = stored("current").filter("property_id < '1'")
    batch.write.parquet(str(tmp_path / "batch"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        bucket = F.lit(1).alias("bucket")
        latest = spark.read.parquet(str(tmp_path / "batch")).select("*", F.lit(1).alias("n_rows"), bucket)
        plan = physical_plan(merge.change_images(stored("current").select("*", bucket), latest, only_newer=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    # The stored rows stream through a broadcast join; only keys that the batch has meet it again.
    assert plan.index("BroadcastHashJoin") < plan.index("FileScan")
    assert not [p for p in plan.split(" Exchange ")[1:] if "house_price" in p.split("\n")[1]]


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_query_joins_every_pair(spark, sf_dir, name):
    plan = physical_plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_raw_dedup_combines_before_the_shuffle(stored):
    raw = stored("raw").select(*RAW_COLUMNS)
    plan = physical_plan(dedup.append_dedup(raw, raw.withColumn("Source", F.lit("y"))))
    assert _count(plan, "Exchange") == 1 and plan.count("HashAggregate") == 2


def test_rows_for_the_archive_are_shuffled_once(spark, stored, tmp_path):
    archive = raw_archive(spark, str(tmp_path / "archive"), 16)
    append_raw(archive, stored("raw"))
    twice = archive.dealt(dedup.fingerprinted(stored("raw").unionByName(stored("raw")))).dropDuplicates(["fingerprint"])
    assert physical_plan(archive.unseen(twice, dealt=True)).count("Exchange") == 1
    n = archive.read().count()
    raw = stored("raw").select(*RAW_COLUMNS)
    later = raw.withColumn("Created_At", F.lit("2025-01-01 00:00:00"))
    assert append_raw(archive, later.unionByName(raw).unionByName(later)) == later.distinct().count()
    assert archive.read().count() == n + later.distinct().count() == archive.read().dropDuplicates(["fingerprint"]).count()
