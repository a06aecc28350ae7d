"""Dedup, merges, gate and numbering against plain Python on small rows."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import NOON, clean_rows, listing
from lotmill.operators import dedup, gate, merge
from lotmill.operators.surrogate import extend_names, number_names
from lotmill.schemas import CLEAN_COLUMNS, CURRENT_COLUMNS, RAW_COLUMNS

STORED_AT = datetime(2024, 1, 1)


def _batch(seed: int, n: int, keys: int) -> list[dict]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of the rows share one key.
        key = "hot" if rng.random() < 0.34 else f"k{rng.randrange(keys)}"
        rows.append(
            listing(key, rng.choice([100, 200, 300]), rng.randint(1, 9), rng.randint(1, 5), house_name=f"n{i}")
        )
    return rows


def _order(row: dict):
    return (row["created_at"], *(row[c] for c in sorted(set(CLEAN_COLUMNS) - {"created_at"})))


def _apply(stored: dict, batch: list[dict], only_newer: bool) -> dict:
    """Upsert the latest row of each key of a batch, one by one."""
    latest: dict[str, dict] = {}
    for row in sorted(batch, key=_order):
        latest[row["property_id"]] = row
    table = dict(stored)
    for key, new in latest.items():
        old, row = table.get(key), dict(new)
        if old and only_newer:
            newer = old["posted_date"] < new["posted_date"]
            if not (newer and old["house_price"] != new["house_price"]):
                row["house_price"] = old["house_price"]
            if not newer:
                row["posted_date"] = old["posted_date"]
        table[key] = row
    return table


@pytest.mark.parametrize("only_newer", [False, True])
def test_images_of_a_large_batch_are_those_of_a_small_one(spark, only_newer):
    stored = {r["property_id"]: r for r in _batch(1, 60, 40)}
    # A key that is stored twice, and rows without a key, which meet nothing.
    rows = [*stored.values(), stored["hot"], listing(None)]
    bucket = F.lit(0).alias("bucket")
    existing = merge.with_versioning(clean_rows(spark, rows), STORED_AT).select("*", bucket)
    same = merge.counted_latest(clean_rows(spark, list(stored.values())[:10]), NOON)
    latest = merge.counted_latest(clean_rows(spark, [*_batch(2, 300, 60), listing(None)]), NOON)
    latest = latest.join(same, "property_id", "left_anti").unionByName(same).select("*", bucket)
    ways = [merge.change_images(existing, latest, only_newer, small) for small in (True, False)]
    assert ways[0].dtypes == ways[1].dtypes
    got = [sorted(df.collect(), key=str) for df in ways]
    assert got[0] == got[1] and {r.action for r in got[0]} == {"insert", "update", "unchanged"}


@pytest.mark.parametrize("only_newer", [False, True])
def test_upserts_against_row_by_row(spark, only_newer):
    stored = {r["property_id"]: r for r in _batch(1, 60, 40)}
    batch = _batch(2, 300, 60)
    existing = merge.with_versioning(clean_rows(spark, list(stored.values())), STORED_AT)
    run = merge.merge_if_newer if only_newer else merge.upsert_latest
    got = {r.property_id: r for r in run(existing, clean_rows(spark, batch), NOON).collect()}
    expected = _apply(stored, batch, only_newer)
    assert got.keys() == expected.keys()
    touched = {r["property_id"] for r in batch}
    for key, row in expected.items():
        assert {c: got[key][c] for c in CLEAN_COLUMNS} == row
        assert got[key].valid_from == (NOON if key in touched else STORED_AT)
        assert got[key].is_current and len(got[key].row_hash) == 64


def test_upsert_is_idempotent_and_keeps_valid_to(spark):
    existing = merge.with_versioning(clean_rows(spark, [listing("a"), listing("b")]), STORED_AT)
    closed = datetime(2024, 3, 1)
    existing = existing.withColumn("valid_to", F.lit(closed).cast("timestamp_ntz"))
    batch = clean_rows(spark, [listing("b", 5), listing("c", 6)])
    once = merge.upsert_latest(existing, batch, NOON)
    twice = merge.upsert_latest(once, batch, NOON)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert once.columns == CURRENT_COLUMNS
    assert {r.property_id: r.valid_to for r in once.collect()} == {"a": closed, "b": closed, "c": None}


def test_newer_merge_with_null_dates_keeps_stored(spark):
    stored = merge.with_versioning(clean_rows(spark, [listing("a", 100, posted_date=None)]), STORED_AT)
    batch = clean_rows(spark, [listing("a", 200), listing("b", 300, posted_date=None)])
    got = {r.property_id: r for r in merge.merge_if_newer(stored, batch, NOON).collect()}
    assert got["a"].house_price == Decimal("100.00") and got["a"].posted_date is None
    assert got["b"].house_price == Decimal("300.00")


def test_insert_ignore_against_row_by_row(spark):
    stored = {r["property_id"]: r for r in _batch(3, 30, 40)}
    batch = _batch(4, 300, 60)
    first: dict[str, dict] = {}
    for row in sorted(batch, key=_order):
        if row["property_id"] not in stored:
            first.setdefault(row["property_id"], row)
    new = merge.insert_ignore(clean_rows(spark, list(stored.values())), clean_rows(spark, batch))
    got = {r.property_id: {c: r[c] for c in CLEAN_COLUMNS} for r in new.collect()}
    assert got == first


def test_merge_counts(spark):
    stored = clean_rows(spark, [listing("a"), listing("b")])
    batch = clean_rows(spark, [listing("b"), listing("b", 2), listing("c"), listing("c", 2), listing("d")])
    got = {r.action: r.n_rows for r in merge.merge_counts(stored, batch).collect()}
    assert got == {"inserted": 2, "updated": 3}
    none = merge.merge_counts(stored, clean_rows(spark, []))
    assert {r.action: r.n_rows for r in none.collect()} == {"inserted": 0, "updated": 0}


def test_row_hash_follows_content_only(spark):
    a, b, c = (
        merge.with_versioning(clean_rows(spark, [listing("a", p)]), t).first().row_hash
        for p, t in ((1, NOON), (1, STORED_AT), (2, NOON))
    )
    assert a == b != c


def test_keep_first_and_last_use_the_given_order(spark):
    df = spark.sql("select * from values ('a', 1, 'x'), ('a', 3, 'y'), ('a', 2, 'z') as t(k, n, v)")
    assert dedup.keep_first(df, "k", [F.col("n")]).first().v == "x"
    assert dedup.keep_last(df, "k", [F.col("n")]).first().v == "y"


def test_gate_splits_every_row(spark):
    rows = [
        listing("ok"),
        listing("no-date", posted_date=None),
        listing("long", source="x" * 10),
        listing("p" * 51),
        listing("both", created_at=None, agent_name="a" * 101),
    ]
    df = clean_rows(spark, rows)
    assert [r.property_id for r in gate.passing(df).collect()] == ["ok"]
    got = {r.property_id: r.violation for r in gate.rejected(df).collect()}
    assert got == {
        "no-date": "null:posted_date",
        "long": "length:source",
        "p" * 51: "length:property_id",
        "both": "null:created_at",
    }


def test_append_dedup(spark):
    columns = ", ".join(f"{c} string" for c in RAW_COLUMNS)
    row = tuple(f"v{i}" for i in range(13))
    with_null = (None, *row[1:])
    upper = tuple(f" V{i}\t" for i in range(13))
    later = (*row[:12], "v12-later")
    old = spark.createDataFrame([row, with_null], columns)
    new = spark.createDataFrame([upper, with_null, later], columns)
    got = dedup.append_dedup(old, new).collect()
    assert sorted(got, key=str) == sorted([row, with_null, later], key=str)
    narrow = dedup.append_dedup(old, new.drop("Lot_Type"))
    assert narrow.count() == 5 and set(narrow.columns) == set(RAW_COLUMNS)


@pytest.mark.parametrize("buckets", [1, 7, 256])
def test_ids_are_dense_and_stable(spark, buckets):
    names = spark.range(1000).select(F.concat(F.lit("n"), "id").alias("name"))
    ids = {r.name: r.i for r in number_names(names, "name", "i", buckets=buckets).collect()}
    assert sorted(ids.values()) == list(range(1, 1001))
    shuffled = names.repartition(13).orderBy(F.rand(3))
    again = number_names(shuffled, "name", "i", buckets=buckets)
    assert {r.name: r.i for r in again.collect()} == ids


def test_new_names_get_the_next_ids(spark):
    old = spark.sql("select * from values (4, 'a'), (9, 'b') as t(id, name)")
    names = spark.sql("select * from values ('a'), ('c'), ('d') as t(name)")
    got = {r.name: r.id for r in extend_names(old, names, "name", "id").collect()}
    assert got.keys() == {"c", "d"} and sorted(got.values()) == [10, 11]
    empty = extend_names(old.filter("id < 0"), names, "name", "id")
    assert sorted(r.id for r in empty.collect()) == [1, 2, 3]
