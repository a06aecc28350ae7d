"""Dimensions, fact and marts on small rows."""

from collections import Counter
from datetime import date, datetime

from helpers import clean_rows, listing
from lotmill.plans import marts, star

ROWS = [
    listing("a", 100, state="Johor", area="North", agent_name="Ann"),
    listing("b", 200, state="Kedah", area="North", agent_name="Ann"),
    listing("c", 400, state="Johor", area="South", agent_name="Bob", lot_type=None),
    listing("d", 800, state=None, area="South", agent_name="Bob"),
    listing("e", 1600, state="Johor", area="South", agent_name=None, posted_date=None),
]


def _star(spark, tmp_path):
    current = clean_rows(spark, ROWS)
    return current, star.write_star(spark, current, str(tmp_path))


def test_dimensions(spark, tmp_path):
    _, built = _star(spark, tmp_path)
    rows = {n: d.collect() for n, d in built.dims.items()}
    states = {r.state_name: r.state_id for r in rows["dim_state"]}
    assert sorted(states) == ["Johor", "Kedah"] and sorted(states.values()) == [1, 2]
    areas = {r.area_name: r.state_id for r in rows["dim_area"]}
    assert areas == {"North": states["Johor"], "South": states["Johor"]}
    assert [r.lot_type_name for r in rows["dim_lot_type"]] == ["Corner"]
    assert sorted(r.agent_name for r in rows["dim_agent"]) == ["Ann", "Bob"]
    ranges = {r.price_range_id: r.range_label for r in rows["dim_price_range"]}
    assert ranges == {1: "0-500k", 2: "500k-1M", 3: "1M-1.5M", 4: "1.5M+"}
    (day,) = rows["dim_date"]
    assert (day.date, day.quarter, day.day_of_week, day.week_of_year) == (date(2024, 1, 1), 1, 1, 1)


def test_calendar_of_sundays_and_year_ends(spark, tmp_path):
    days = [datetime(2023, 1, 1, 23), datetime(2024, 12, 30), datetime(2024, 2, 29, 1)]
    current = clean_rows(spark, [listing(str(i), posted_date=d) for i, d in enumerate(days)])
    got = {r.date: (r.day_of_week, r.week_of_year, r.quarter) for r in star.dim_date(current).collect()}
    expected = {
        d.date(): (d.isoweekday() % 7, d.isocalendar()[1], (d.month + 2) // 3) for d in days
    }
    assert got == expected


def test_fact_drops_rows_without_a_name(spark, tmp_path):
    _, built = _star(spark, tmp_path)
    rows = built.fact.collect()
    assert sorted(r.property_id for r in rows) == ["a", "b", "c"]
    assert len({r.sale_id for r in rows}) == 3
    # Areas join by name alone, so a listing keeps its own state.
    assert len({r.state_id for r in rows}) == 2


def test_marts(spark, tmp_path):
    current, built = _star(spark, tmp_path)
    got = {
        n: Counter(tuple(r) for r in m.collect())
        for n, m in marts.all_marts(current, built.fact, built.dims["dim_agent"]).items()
    }
    assert got["avg_price_by_state"] == Counter(
        [("Johor", 700.0, 3), ("Kedah", 200.0, 1), (None, 800.0, 1)]
    )
    assert got["time_series_prices"] == Counter([(date(2024, 1, 1), 375.0, 4), (None, 1600.0, 1)])
    assert got["posting_dates"] == Counter([(date(2024, 1, 1), 4), (None, 1)])
    assert got["furniture_status"] == Counter([("Unfurnished", 5)])
    assert sorted(r[1:4] for r in got["agent_summary"]) == [("Ann", 300, 150.0), ("Bob", 400, 400.0)]
    assert sum(r[-1] * n for r, n in got["detailed_sales_summary"].items()) == 3


def test_detail_equals_the_joined_form(spark, tmp_path):
    current, built = _star(spark, tmp_path)
    dims = built.dims
    joined = (
        current.join(dims["dim_state"], current.state == dims["dim_state"].state_name)
        .join(dims["dim_area"].select("area_name"), current.area == dims["dim_area"].area_name)
        .join(dims["dim_property_type"], current.house_type == dims["dim_property_type"].property_type_name)
        .join(dims["dim_agent"], "agent_name")
    )
    assert joined.count() == 3
    assert sorted(r.state for r in marts.detailed_sales_summary(current).collect()) == sorted(
        r.state for r in joined.select("state").collect()
    )


def test_null_key_gives_two_rows(spark):
    df = spark.sql("select * from values ('a', 1, 1), ('a', 3, 2), (null, 5, 3) as t(k, v, id)")
    got = Counter(tuple(r) for r in marts.averages_full_outer(df, "k", "v", "id").collect())
    assert got == Counter([("a", 2.0, 2), (None, 5.0, None), (None, None, 1)])


def test_ids_stay_over_runs_and_new_names_follow(spark, tmp_path):
    folder = str(tmp_path / "star")
    ids = lambda dims, name, key: {r[name]: r[key] for r in dims.collect()}
    first = star.write_dimensions(spark, clean_rows(spark, [listing("a"), listing("b", agent_name="Zed", state="Perak", area="Ipoh")]), folder)
    before = ids(first["dim_agent"], "agent_name", "agent_id")
    areas = ids(first["dim_area"], "area_name", "area_id")
    later = clean_rows(spark, [listing("c", agent_name="Abe"), listing("d", agent_name="Zed", area="Muar", day=7)])
    for _ in range(2):  # a repeated run adds nothing
        second = star.write_dimensions(spark, later, folder)
        after = ids(second["dim_agent"], "agent_name", "agent_id")
        assert after == {**before, "Abe": 3}
        assert ids(second["dim_area"], "area_name", "area_id") == {**areas, "Muar": 3}
        assert second["dim_date"].count() == 2 and second["dim_price_range"].count() == 4
