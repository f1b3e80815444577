"""The incremental refresh with monthly and daily partitions."""

from dataclasses import replace

from pyspark.sql import functions as F

import pytest

from check import rows_of
from voltmart.plans import warehouse
from voltmart.session import work_dir
from voltmart.sources import sinks
from voltmart.suite.layers import in_two_parts, sources

SF = "/root/testdata/sf0.001"
START, FIRST, SECOND = "2001-07-01", "2001-07-20", "2001-08-01"


def test_daily_partitions_give_the_same_marts(spark):
    """Two runs each over the last month; the second one brings new rows and changed ones."""
    whole = sources(spark, SF)
    whole = replace(
        whole,
        offers=whole.offers.filter(F.col("created_at") >= START),
        rentals=whole.rentals.filter(F.col("started_at") >= START),
        offer_audit=whole.offer_audit.filter(F.col("ts") >= START),
    )
    first = replace(
        whole,
        offers=whole.offers.filter(F.col("created_at") < FIRST).withColumn("status", F.lit("ACTIVE")),
        rentals=whole.rentals.filter(F.col("started_at") < FIRST).withColumn("status", F.lit("ACTIVE")),
        offer_audit=whole.offer_audit.filter(F.col("ts") < "2001-07-10"),
    )
    second = replace(whole, offers=whole.offers.filter(F.col("created_at") >= FIRST))
    results = []
    for grain in (warehouse.MONTHLY, warehouse.DAILY):
        root = work_dir(spark, "test")
        warehouse.refresh_warehouse(spark, first, root, START, FIRST, grain=grain)
        paths = warehouse.refresh_warehouse(spark, second, root, START, SECOND, since=FIRST, grain=grain)
        marts = {}
        for name, path in paths.items():
            mart = spark.read.parquet(path)
            marts[name] = rows_of(mart.columns, mart.collect())
        results.append(marts)
        facts = spark.read.parquet(f"{root}/dds/fact_rentals")
        assert facts.count() == facts.select("rental_id").distinct().count() == whole.rentals.count()
    assert results[0] == results[1]
    assert sum(results[0]["dm_daily_metrics"].values()) == 32


def recent(whole):
    """A short period, so that few partitions are written."""
    return replace(
        whole,
        offers=whole.offers.filter(F.col("created_at") >= START),
        rentals=whole.rentals.filter(F.col("started_at") >= START),
        cost_snapshots=whole.cost_snapshots.filter(F.col("ts") >= START),
        offer_audit=whole.offer_audit.filter(F.col("ts") >= START),
    )


def test_two_runs_over_disjoint_parts_equal_one_over_all(spark):
    """Late users, stations described late, costs and status changes before or after what they belong
    to, offers after their rentals: facts and all marts end where one run over everything does."""
    whole = recent(sources(spark, SF))
    one, two = work_dir(spark, "one"), work_dir(spark, "two")
    results = [warehouse.refresh_warehouse(spark, whole, one, START, SECOND)]
    first, second = in_two_parts(whole)
    warehouse.refresh_warehouse(spark, first, two, START, FIRST)
    assert sinks.read_version(spark, "fact_rentals", f"{two}/waiting").count() > 0
    results.append(warehouse.refresh_warehouse(spark, second, two, START, SECOND, since=FIRST))
    for fact in ("fact_rentals", "fact_offers"):
        rows = []
        for root in (one, two):
            df = spark.read.parquet(f"{root}/dds/{fact}")
            df = df.drop("user_dwh_id", "dw_loaded_at", "dw_updated_at")
            rows.append(rows_of(df.columns, df.collect()))
        assert rows[0] == rows[1], fact
    for mart in results[0]:
        rows = []
        for paths in results:
            df = spark.read.parquet(paths[mart])
            rows.append(rows_of(df.columns, df.collect()))
        assert rows[0] == rows[1], mart
    assert sinks.read_version(spark, "fact_rentals", f"{two}/waiting").count() == 0


def test_costs_and_statuses_follow_their_time_not_their_arrival(spark, make):
    whole = sources(spark, SF)
    root = work_dir(spark, "test")
    tariff = '{"base_rate": 5.0, "segment_multiplier": 1.0, "currency": "RUB"}'
    offer = lambda rows: make(
        "offer_id string, user_id string, station_id string, tariff_snapshot string, created_at timestamp, "
        "expires_at timestamp, status string, tariff_version string", rows)
    rental = lambda rows: make(
        "rental_id string, offer_id string, user_id string, station_id string, started_at timestamp, "
        "finished_at timestamp, status string, tariff_version string", rows)
    cost = lambda rows: make("id string, rental_id string, ts timestamp, cost_amount decimal(10,2), details string", rows)
    audit = lambda rows: make("id string, offer_id string, event_type string, ts timestamp, payload_json string", rows)
    user = make("user_id string, email string, phone string, status string, created_at timestamp",
                [("u", "e", None, "ACTIVE", "2024-01-01 00:00:00")])
    segments = make("user_id string, segment string", [("u", "VIP")])
    stations = make("station_id string, station_name string", [("s", "one")])
    to = lambda status: '{"new_status": "%s"}' % status
    o = lambda key, status: (key, "u", "s", tariff, "2024-01-01 00:00:00", "2024-01-01 00:05:00", status, "v1")
    r = lambda key, of, status="FINISHED": (key, of, "u", "s", "2024-01-01 00:01:00", "2024-01-01 00:09:00", status, None)
    base = replace(whole, users=user, segments=segments, stations=stations)
    first = replace(
        base, offers=offer([o("o1", "ACTIVE")]), rentals=rental([r("r1", "o1"), r("r2", "o2"), r("r4", "o1")]),
        cost_snapshots=cost([("c1", "r1", "2024-01-01 00:09:00", "100", None), ("c3", "r3", "2024-01-01 00:09:00", "30", None)]),
        offer_audit=audit([("a2", "o1", "STATUS_CHANGED", "2024-01-01 00:02:00", to("USED")),
                           ("a3", "o2", "STATUS_CHANGED", "2024-01-01 00:02:00", to("USED"))]),
    )
    second = replace(
        base, offers=offer([o("o2", "ACTIVE")]), rentals=rental([r("r1", "o1"), r("r3", "o1"), r("bad", "o1", "LOST")]),
        cost_snapshots=cost([("c0", "r1", "2024-01-01 00:08:00", "1", None), ("c4", "r4", "2024-01-01 00:09:00", "40", None)]),
        offer_audit=audit([("a1", "o1", "STATUS_CHANGED", "2024-01-01 00:01:00", to("ACTIVE"))]),
    )
    warehouse.refresh_warehouse(spark, first, root, "2024-01-01", "2024-01-02", grain=warehouse.DAILY)
    warehouse.refresh_warehouse(spark, second, root, "2024-01-01", "2024-01-03", since="2024-01-02",
                                grain=warehouse.DAILY, checked=True)
    rentals = {x.rental_id: x for x in spark.read.parquet(f"{root}/dds/fact_rentals").collect()}
    assert {k: x.final_cost and int(x.final_cost) for k, x in rentals.items()} == {"r1": 100, "r2": None, "r3": 30, "r4": 40}
    assert all(x.tariff_dwh_id is not None for x in rentals.values())
    offers = {x.offer_id: x.status for x in spark.read.parquet(f"{root}/dds/fact_offers").collect()}
    assert offers == {"o1": "USED", "o2": "USED"}
    found = {(x.check_name, x.table_name): x.observed for x in spark.read.parquet(f"{root}/dq").collect()}
    assert found["quarantine", "rentals"] == "1" and found["waiting", "cost_snapshots"] == "0"
    with pytest.raises(ValueError, match="cannot follow"):
        warehouse.refresh_warehouse(spark, second, root, "2024-01-01", "2024-01-03", since="2024-01-03")


def test_raw_days_past_retention_move_to_the_archive(spark, make):
    root = work_dir(spark, "test")
    for day in ("2024-01-01", "2024-03-01"):
        rows = make("user_id string, loaded_at timestamp", [(day, f"{day} 00:00:00")])
        sinks.append_raw(rows.withColumn("load_date", F.to_date("loaded_at")), f"{root}/raw/users")
    for _ in range(2):
        warehouse.archive_layers(spark, root, "2024-03-02")
    left = lambda path: [r.user_id for r in spark.read.parquet(f"{root}/{path}").collect()]
    assert left("raw/users") == ["2024-03-01"] and left("archive/raw/users") == ["2024-01-01"]
