"""Incremental ingest: each file once, repeatable, side by side with other writers."""

import os
from datetime import datetime

import pytest

from helpers import clean_rows, listing, raw_rows
from lotmill.plans.load import LoadOptions, current_table, load_batch, stored
from lotmill.sources import files, tables
from lotmill.streaming import visits
from lotmill.streaming.ingest import start_ingest

AS_OF = datetime(2024, 1, 31, 12)


def _link(n):
    return f"https://www.x.com/property/kl/sale-{n}"


def _drop(spark, raw, *numbers, agent="one", **other):
    rows = [{"Page_Link": _link(n), "Agent_Name": agent, **other} for n in numbers]
    files.write_raw(raw_rows(spark, rows), raw)


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        raw, root = str(tmp_path / "raw"), str(tmp_path / "out")
        store = current_table(spark, str(tmp_path / "out"))

        def run(self, checkpoint="checkpoint", files_per_batch=None):
            options = LoadOptions(only_newer=False)
            start_ingest(
                spark, self.raw, self.root, f"{self.root}/{checkpoint}", AS_OF, files_per_batch, options
            ).awaitTermination()
            return self.rows()

        def batches(self):
            return os.listdir(f"{self.root}/current_listings/changes")

        def rows(self):
            return {r.property_id: r.agent_name for r in self.store.read().collect()}

    return Place()


def test_each_file_counts_once_and_rejects_are_kept(spark, place):
    _drop(spark, place.raw, 1, 2)
    assert place.run() == {"sale-1": "One", "sale-2": "One"}
    assert place.run() == {"sale-1": "One", "sale-2": "One"}
    assert len(place.batches()) == 1
    later = {"Created_At": "2024-02-01 12:00:00"}
    _drop(spark, place.raw, 2, 3, agent="two", **later)
    _drop(spark, place.raw, 4, Posted_Date="unknown")
    _drop(spark, place.raw, 5, House_Price="rm 1,000 - rm 2,000 - rm 3,000")
    assert place.run(files_per_batch=1) == {"sale-1": "One", "sale-2": "Two", "sale-3": "Two"}
    rejects = {r.property_id: r.reason for r in stored(spark, place.root, "rejected_listings").collect()}
    assert rejects == {"sale-4": "null:posted_date", "sale-5": "price_range"}
    assert place.run() and stored(spark, place.root, "rejected_listings").count() == 2
    counts = stored(spark, place.root, "loads").groupBy().sum().first().asDict()
    assert counts["sum(inserted)"] == 3 and counts["sum(turned_back)"] == 1 and counts["sum(unreadable)"] == 1
    assert stored(spark, place.root, "cleaned_listings").count() == 6


def test_a_stream_adds_to_a_loaded_table(spark, place):
    tables.incremental_load(place.store, clean_rows(spark, [listing("sale-1"), listing("sale-2")]), AS_OF)
    _drop(spark, place.raw, 3)
    assert set(place.run()) == {"sale-1", "sale-2", "sale-3"}


def test_stream_load_stream(spark, place):
    _drop(spark, place.raw, 1)
    place.run()
    tables.incremental_load(place.store, clean_rows(spark, [listing("sale-2")]), AS_OF)
    _drop(spark, place.raw, 3)
    assert set(place.run()) == {"sale-1", "sale-2", "sale-3"}
    assert len(place.batches()) == 3


def test_a_new_checkpoint_on_an_old_table(spark, place):
    for n in (1, 2):
        _drop(spark, place.raw, n)
        place.run()
    _drop(spark, place.raw, 3, agent="new")
    assert place.run("another") == {"sale-1": "One", "sale-2": "One", "sale-3": "New"}
    assert len(place.batches()) == 3


def test_a_recorded_batch_is_not_merged_again(spark, place):
    _drop(spark, place.raw, 1)
    lines = spark.read.schema("value string").option("recursiveFileLookup", "true").text(place.raw)
    headers = files.file_headers(lines).collect()
    first = load_batch(spark, headers, place.root, AS_OF, "me", 0)
    again = load_batch(spark, headers, place.root, AS_OF, "me", 0)
    assert first == again and (first["inserted"], first["rows"], first["files"]) == (1, 1, 1)
    assert len(place.batches()) == 1
    assert spark.read.parquet(f"{place.root}/raw_listings").count() == 1
    assert load_batch(spark, headers, place.root, AS_OF, "you", 0)["unchanged"] == 1


def test_a_page_is_visited_once_over_all_runs(spark, tmp_path):
    root, folder = str(tmp_path / "out"), str(tmp_path / "pages")

    def visit(*rows):
        spark.createDataFrame(rows, visits.PAGES).write.mode("append").parquet(folder)
        visits.start_visits(spark, folder, root, f"{root}/checkpoint", AS_OF).awaitTermination()
        return sorted((str(r.url), r.page_id, r.batch) for r in spark.read.parquet(f"{root}/visits").collect())

    challenge = "<p>Checking your browser</p>"
    assert visit((1, "u", "<p>x</p>"), (2, "v", challenge), (3, None, "<p>y</p>")) == [("None", 3, 0), ("u", 1, 0)]
    found = visit((4, "u", "<p>x</p>"), (5, "v", "<p>x</p>"), (6, None, "<p>y</p>"), (7, "w", challenge))
    assert found == [("None", 3, 0), ("None", 6, 1), ("u", 1, 0), ("v", 5, 1)]
    assert visit((8, "v", "<p>z</p>")) == found
    state = [f for _, _, fs in os.walk(f"{root}/checkpoint/state") for f in fs]
    assert any(f.endswith((".zip", ".changelog", ".sst")) for f in state)
