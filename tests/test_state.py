"""Marts kept up by signed deltas equal marts computed from the facts, run after run."""

import random

import pytest

from check import rows_of
from voltmart.operators import dims
from voltmart.plans import marts, state, warehouse
from voltmart.session import work_dir
from voltmart.sources import sinks
from voltmart.suite.increment_queries import load

START, RUNS = "2024-01-01", ["2024-02-10", "2024-02-20", "2024-03-15"]
RENTAL = ("rental_id string, user_id string, station_dwh_id string, tariff_dwh_id string, start_date_id int, "
          "start_time_id int, duration_minutes int, final_cost decimal(10,2), is_completed boolean, "
          "is_cancelled boolean, month_id int")
OFFER = "offer_id string, created_date_id int, status string, expires_at timestamp, month_id int"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rental(dice, n):
    day = dice.randrange(1, 75)
    date = 20240100 + day if day <= 31 else 20240200 + day - 31 if day <= 60 else 20240300 + day - 60
    done = dice.choice([True, False, None])
    return (f"r{n}", dice.choice([None, "a", "b", "c"]), dice.choice(["s1", "s2", "s3"]), dice.choice(["t1", None]), date,
            dice.choice([90000, 173001, 0]), dice.choice([None, 5, 9]), dice.choice([None, "1.50", "-2.25", "7.00"]), done,
            done is False, date // 100)


def offer(dice, n):
    status = dice.choice(["ACTIVE", "ACTIVE", "USED", "EXPIRED"])
    day = dice.randrange(1, 28)
    return (f"o{n}", 20240200 + day, status, dice.choice([None, f"2024-02-{day:02d} 12:00:00", "2024-03-01 00:00:00"]), 202402)


@pytest.fixture
def dimensions(spark, make):
    stations = make("station_dwh_id string, station_id string, station_name string, city string",
                    [(f"s{i}", f"{i}", f"n{i}", "here" if i % 2 else "there") for i in (1, 2, 3)])
    tariffs = make("tariff_dwh_id string, tariff_type string", [("t1", "standard")])
    return dims.dim_date(spark, START, "2024-12-31"), dims.dim_time(spark), stations, tariffs


def increments(seed):
    """Three runs: new rows, corrected rows, rows that moved to another day, station or user."""
    dice = random.Random(seed)
    rentals = [rental(dice, n) for n in range(80)]
    offers = [offer(dice, n) for n in range(40)]
    yield rentals, offers
    yield ([rental(dice, n) for n in range(20, 60)] + [rental(dice, n) for n in range(100, 120)],
           [offer(dice, n) for n in range(10, 50)])
    yield [rental(dice, n) for n in range(0, 30)], offers[:5]


def full(spark, root, parts, as_of):
    days, times, stations, tariffs = parts
    rentals = spark.read.parquet(f"{root}/dds/fact_rentals")
    offers = warehouse.expire_open_offers(spark.read.parquet(f"{root}/dds/fact_offers"), as_of)
    return {
        "dm_daily_metrics": marts.dm_daily_metrics(days, rentals, offers, as_of),
        "dm_station_stats": marts.dm_station_stats(stations, rentals, as_of),
        "dm_hourly_demand": marts.dm_hourly_demand(rentals, days, times, as_of),
        "dm_revenue_breakdown": marts.dm_revenue_breakdown(rentals, days, tariffs, stations, as_of),
    }


def equal(spark, root, parts, paths, as_of):
    for name, view in full(spark, root, parts, as_of).items():
        got = spark.read.parquet(paths[name])
        assert got.columns == view.columns
        assert rows_of(got.columns, got.collect()) == rows_of(view.columns, view.collect()), name


def test_three_runs_equal_full_marts(spark, make, dimensions):
    days, times, stations, tariffs = dimensions
    root, since = work_dir(spark, "test"), START
    for as_of, (rentals, offers) in zip(RUNS, increments(1)):
        changes = [load(spark, root, "fact_rentals", "rental_id", make(RENTAL, rentals), as_of),
                   load(spark, root, "fact_offers", "offer_id", make(OFFER, offers), as_of)]
        for _ in range(2 if as_of == RUNS[1] else 1):  # a run that is repeated adds nothing
            paths = state.refresh(spark, root, days, times, stations, tariffs, *changes, as_of, since)
        equal(spark, root, dimensions, paths, as_of)
        since = as_of
    # One base instead of three runs, then one from the facts: the same state.
    reads = lambda: {n: rows_of(df.columns, df.collect()) for n in state.STATES for df in [state.read_state(spark, root, n)]}
    before = reads()
    state.compact(spark, root, RUNS[-1])
    assert reads() == before and all(len(state._live(spark, root, n)) == 1 for n in state.STATES)
    state.add_changes(spark, root, RUNS[-1], *changes)  # a late repetition of a run that is in the base
    assert reads() == before
    facts = [spark.read.parquet(f"{root}/dds/{n}") for n in ("fact_rentals", "fact_offers")]
    state.rebuild(spark, root, RUNS[-1], *facts)
    assert reads() == before


def test_a_run_repeated_after_its_swap_finds_its_changes(spark, make):
    root = work_dir(spark, "test")
    (first, _), (second, _), _ = increments(2)
    load(spark, root, "fact_rentals", "rental_id", make(RENTAL, first), RUNS[0])
    changes = [rows_of(df.columns, df.collect()) for df in
               (load(spark, root, "fact_rentals", "rental_id", make(RENTAL, second), RUNS[1]) for _ in range(2))]
    assert changes[0] == changes[1] and len(changes[0]) > 40


def test_signed_changes(make):
    schema = "k string, a int, b string"
    old = make(schema, [("same", 1, None), ("changed", 1, "x"), ("gone", 2, "y"), ("null", None, None), (None, 1, "n")])
    new = make(schema, [("same", 1, None), ("changed", 2, "x"), ("new", 3, "z"), ("null", None, "v"), (None, 1, "n")])
    got = sorted(map(tuple, sinks.signed_changes(old, new, ["k"]).collect()), key=str)
    assert got == sorted([("changed", 1, "x", -1), ("changed", 2, "x", 1), ("gone", 2, "y", -1), ("new", 3, "z", 1),
                          ("null", None, None, -1), ("null", None, "v", 1)], key=str)


def test_only_touched_days_are_read_and_no_fact(spark, make, dimensions):
    days, times, stations, tariffs = dimensions
    root = work_dir(spark, "test")
    (rentals, offers), _, _ = increments(3)
    changes = [load(spark, root, "fact_rentals", "rental_id", make(RENTAL, rentals), RUNS[0]),
               load(spark, root, "fact_offers", "offer_id", make(OFFER, offers), RUNS[0])]
    state.refresh(spark, root, days, times, stations, tariffs, *changes, RUNS[0], START)
    moved = rental(random.Random(8), 3)
    later = load(spark, root, "fact_rentals", "rental_id", make(RENTAL, [moved]), RUNS[1])
    state.add_changes(spark, root, RUNS[1], later, changes[1].limit(0))
    touched = state.touched_days(spark, root, days, later, changes[1].limit(0), RUNS[0], RUNS[1])
    assert len(touched) < 30 and {moved[4], next(r for r in rentals if r[0] == "r3")[4]} & set(touched)
    # what the day-by-day view reads
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = plan_of(state.daily_metrics(spark, root, days, RUNS[1], 90, touched))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans and all("/state/" in line or "values" in line for line in scans)
    assert all(f"In({'start' if 'start_date_id' in line else 'created'}_date_id" in line for line in scans)
    assert "/dds/" not in plan
    for view in (state.station_stats(spark, root, stations, RUNS[1]),
                 state.hourly_demand(spark, root, days, times, RUNS[1]),
                 state.revenue_breakdown(spark, root, days, tariffs, stations, RUNS[1])):
        assert "/dds/" not in plan_of(view)


def test_state_has_to_be_there(spark):
    with pytest.raises(LookupError, match="rebuild"):
        state.read_state(spark, work_dir(spark, "test"), "offer_sums")


def test_warehouse_by_deltas_equals_warehouse_by_scans(spark):
    from test_warehouse import FIRST, SECOND, START as DAY, recent
    from voltmart.suite.layers import in_two_parts, sources

    first, second = in_two_parts(recent(sources(spark, "/root/testdata/sf0.001")))
    root = work_dir(spark, "test")
    warehouse.refresh_warehouse(spark, first, root, DAY, FIRST, deltas=True)
    by_delta = warehouse.refresh_warehouse(spark, second, root, DAY, SECOND, since=FIRST, deltas=True)
    by_scan = warehouse.refresh_marts(spark, root, DAY, SECOND)
    for name in by_scan:
        rows = [rows_of(df.columns, df.collect()) for df in (spark.read.parquet(p[name]) for p in (by_delta, by_scan))]
        assert rows[0] == rows[1], name
