"""Layers and marts on small hand-made tables: loads, versions, fan-outs, empty days, ties."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from voltmart import schemas
from voltmart.operators import dims, facts, keys, ods, quality
from voltmart.plans import dashboard, marts
from voltmart.sources import extracts, sinks
from voltmart.session import work_dir

USER = "user_id string, email string, phone string, status string, created_at timestamp"
FACT = ("rental_id string, user_dwh_id string, station_dwh_id string, start_date_id int, "
        "status string, duration_minutes int, final_cost decimal(10,2)")
OFFER_FACT = "offer_id string, status string, created_date_id int"


def rentals(make, rows):
    return facts.add_rental_flags(make(FACT, rows))


def offers(make, rows):
    return facts.add_offer_flags(make(OFFER_FACT, rows))


def test_daily_metrics_do_not_multiply_facts(spark, make):
    days = dims.dim_date(spark, "2024-01-01", "2024-01-02")
    two = rentals(make, [("r1", "u1", "s", 20240101, "FINISHED", 5, "10"),
                         ("r2", "u2", "s", 20240101, "FINISHED", 8, "20")])
    three = offers(make, [("o1", "USED", 20240101), ("o2", "EXPIRED", 20240101),
                          ("o3", "ACTIVE", 20240101)])
    rows = {r.date_actual: r for r in marts.dm_daily_metrics(days, two, three, "2024-01-02").collect()}
    first, empty = rows[date(2024, 1, 1)], rows[date(2024, 1, 2)]
    assert first.total_revenue == 30 and first.total_duration_minutes == 13
    assert first.median_rental_cost == 15 and first.active_users == 2
    assert first.offer_to_rental_conversion_rate == Decimal("33.33")
    assert empty.total_rentals == 0 and empty.total_offers_created == 0
    assert empty.total_revenue is None and empty.offer_to_rental_conversion_rate is None


def test_daily_metrics_have_no_future_days(spark, make):
    days = dims.dim_date(spark, "2024-01-01", "2024-12-31")
    daily = marts.dm_daily_metrics(days, rentals(make, [("r", "u", "s", 20240102, "FINISHED", 5, "10")]),
                                   offers(make, [("o", "USED", 20240102)]), "2024-01-02")
    assert dashboard.latest_day(daily).first().date_actual == date(2024, 1, 2)


def test_popularity_rank_ties(make):
    df = make("station_id string, total_rentals_30d bigint", [("a", 5), ("b", 5), ("c", 3)])
    ranks = {r.station_id: r.popularity_rank for r in marts.popularity_rank(df).collect()}
    assert ranks == {"a": 1, "b": 1, "c": 3}


def test_station_stats_keep_empty(make):
    stations = make("station_dwh_id string, station_id string, station_name string, city string",
                    [("s", "1", "one", "x"), ("t", "2", "two", "x")])
    one = rentals(make, [("r", "u", "s", 20240102, "FINISHED", 5, "10"),
                         ("old", "u", "t", 20230102, "FINISHED", 5, "10")])
    assert [r.station_id for r in marts.dm_station_stats(stations, one, "2024-01-02").collect()] == ["1"]
    kept = marts.dm_station_stats(stations, one, "2024-01-02", keep_empty=True).collect()
    assert [(r.station_id, r.total_rentals_30d) for r in kept] == [("1", 1), ("2", 0)]


def test_cohorts(make):
    users = make("user_dwh_id string, user_created_at timestamp",
                 [(u, "2024-01-15 00:00:00") for u in ("m0", "m1", "none", "free")]
                 + [("feb", "2024-02-01 00:00:00")]).withColumn("is_current", F.lit(True))
    facts_ = rentals(make, [
        ("1", "m0", "s", 20240116, "FINISHED", 5, "10"), ("2", "m0", "s", 20240120, "FINISHED", 5, "30"),
        ("3", "m1", "s", 20240210, "FINISHED", 5, "20"), ("4", "free", "s", 20240401, "FINISHED", 5, "0"),
        ("5", "feb", "s", 20240305, "ACTIVE", None, None),
    ])
    cohorts = marts.dm_user_cohorts(users, facts_, "2024-06-01")
    rows = {r.cohort_month: r for r in cohorts.collect()}
    january, february = rows[date(2024, 1, 1)], rows[date(2024, 2, 1)]
    assert (january.cohort_size, january.active_month_0, january.active_month_1) == (4, 1, 1)
    # Users without completed rentals are left out of the averages.
    assert january.avg_rentals_per_user == Decimal("1.3333")
    assert january.avg_revenue_per_user == Decimal("20")
    assert (february.active_month_0, february.active_month_1) == (0, 1)
    retention = {r.cohort_month: r.retention_rate for r in dashboard.cohort_retention(cohorts).collect()}
    assert retention == {date(2024, 1, 1): Decimal("100.00"), date(2024, 2, 1): None}


def test_scd2_versions(make):
    old = make(USER, [("same", "a", None, "ACTIVE", None), ("gains", "a", None, "ACTIVE", None),
                      ("loses", "a", "+7", "ACTIVE", None)])
    new = make(USER, [("same", "a", None, "ACTIVE", None), ("gains", "a", "+7", "ACTIVE", None),
                      ("loses", "a", None, "ACTIVE", None), ("new", "a", None, "ACTIVE", None)])
    dim = dims.new_user_versions(old, "2024-01-01")
    merged = dims.scd2_merge(dim, new, "2024-02-01")
    counts = {r.user_id: r["count"] for r in merged.groupBy("user_id").count().collect()}
    assert counts == {"same": 1, "gains": 2, "loses": 2, "new": 1}
    current = merged.filter("is_current").groupBy("user_id").count()
    assert {r["count"] for r in current.collect()} == {1}
    closed = merged.filter("not is_current").collect()
    assert {r.valid_to for r in closed} == {datetime(2024, 2, 1)}
    assert merged.select("user_dwh_id").distinct().count() == 6
    again = dims.scd2_merge(merged, new, "2024-03-01")
    assert sorted(again.collect()) == sorted(merged.collect())


def test_scd2_refuses_to_go_back(make):
    users = make(USER, [("u", "a", None, "ACTIVE", None)])
    dim = dims.new_user_versions(users, "2024-02-01")
    with pytest.raises(PySparkException, match="precedes an open version"):
        dims.scd2_merge(dim, users, "2024-01-01").collect()


ODS_RENTAL = ("rental_id string, offer_id string, user_id string, station_id string, "
              "started_at timestamp, finished_at timestamp, status string, tariff_version string, "
              "tariff_rate_per_minute decimal(10,4), final_cost decimal(10,2), duration_minutes int")


@pytest.fixture
def star(make):
    users = dims.new_user_versions(make(USER, [("u", "a", None, "ACTIVE", None)]), "2024-01-01")
    stations = make("station_id string, station_dwh_id string", [("s", "S")])
    tariffs = make("tariff_version string, rate_per_minute decimal(10,4), tariff_dwh_id string",
                   [("v1", "5", "T5"), ("v1", "6", "T6")])
    return users, stations, tariffs


def test_fact_upsert_and_tariff_fan_out(make, star):
    active = make(ODS_RENTAL, [("r", "o", "u", "s", "2024-01-05 10:00:00", None, "ACTIVE", "v1", "5",
                                None, None)])
    done = make(ODS_RENTAL, [("r", "o", "u", "s", "2024-01-05 10:00:00", "2024-01-05 10:30:00",
                              "FINISHED", "v1", "5", "200", 30)])
    first = facts.fact_rentals(active, *star, "2024-01-06")
    rows = facts.fact_rentals(done, *star, "2024-01-07", prev=first).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.status, row.final_cost, row.end_time_id, row.is_completed) == ("FINISHED", 200, 103000, True)
    assert row.tariff_dwh_id == "T5"
    assert (row.dw_loaded_at, row.dw_updated_at) == (datetime(2024, 1, 6), datetime(2024, 1, 7))


def test_rejects_name_the_missing_dimension(make, star):
    rows = make(ODS_RENTAL, [
        ("ok", "o", "u", "s", "2024-01-05 10:00:00", None, "ACTIVE", "v9", None, None, None),
        ("user", "o", "x", "s", "2024-01-05 10:00:00", None, "ACTIVE", "v1", "5", None, None),
        ("station", "o", "u", "x", "2024-01-05 10:00:00", None, "ACTIVE", "v1", "5", None, None),
    ])
    rejects = {r.rental_id: r.missing for r in facts.fact_rejects(rows, *star[:2]).collect()}
    assert rejects == {"user": "user", "station": "station"}
    loaded = facts.fact_rentals(rows, *star, "2024-01-06").collect()
    assert [(r.rental_id, r.tariff_dwh_id) for r in loaded] == [("ok", None)]


def test_rental_takes_the_version_of_its_offer(make):
    raw = make("rental_id string, offer_id string, started_at timestamp, finished_at timestamp, "
               "tariff_version string, loaded_at timestamp",
               [("r", "o", "2024-01-01 00:00:00", "2024-01-01 00:00:01", None, "2024-01-02 00:00:00")])
    known = make("offer_id string, tariff_version string", [("o", "v1")])
    row = ods.ods_rentals(raw, known).first()
    assert (row.tariff_version, row.duration_minutes) == ("v1", 1)


def test_open_offer_counts_as_expired(make):
    df = make("offer_id string, status string, expires_at timestamp",
              [("open", "ACTIVE", "2024-01-01 12:00:01"), ("edge", "ACTIVE", "2024-01-01 12:00:00"),
               ("used", "USED", "2024-01-01 11:00:00")])
    got = df.withColumn("s", facts.effective_status("2024-01-01 12:00:00"))
    assert {r.offer_id: r.s for r in got.collect()} == {"open": "ACTIVE", "edge": "EXPIRED", "used": "USED"}


def test_users_absent_from_the_newest_snapshot_are_deleted(make):
    columns = USER + ", loaded_at timestamp"
    first = make(columns, [("a", "a", None, "ACTIVE", None, "2024-01-01 00:00:00"),
                           ("b", "b", None, "ACTIVE", None, "2024-01-01 00:00:00")])
    prev = ods.ods_users(first, None, "2024-01-01")
    # Only the new snapshot is at hand, as in an incremental run.
    second = make(columns, [("a", "a", "+7", "ACTIVE", None, "2024-02-01 00:00:00")])
    rows = {r.user_id: r for r in ods.ods_users(second, prev, "2024-02-01").collect()}
    assert (rows["a"].phone, rows["a"].is_deleted, rows["a"].updated_at) == ("+7", False, datetime(2024, 2, 1))
    assert (rows["b"].email, rows["b"].is_deleted, rows["b"].updated_at) == ("b", True, datetime(2024, 2, 1))
    quiet = ods.ods_users(first.limit(0), prev, "2024-02-01")
    assert not any(r.is_deleted for r in quiet.collect())
    third = ods.ods_users(second, ods.ods_users(second, prev, "2024-02-01"), "2024-03-01")
    assert {r.updated_at for r in third.collect()} == {datetime(2024, 2, 1)}


def test_quarantine(make):
    schema = T.StructType([T.StructField("n", T.IntegerType(), False), T.StructField("s", T.StringType())])
    df = make("n string, s string", [("1", "ACTIVE"), ("x", "ACTIVE"), (None, "ACTIVE"), ("2", "odd"), ("3", None)])
    ok, bad = ods.validate_types(df, schema, {"s": schemas.OFFER_STATUSES})
    assert sorted(r.n for r in ok.collect()) == [1, 3] and bad.count() == 3


def test_extract_takes_the_latest_cost(make):
    rows = make("rental_id string", [("r",), ("none",)])
    costs = make("rental_id string, ts timestamp, id string, cost_amount decimal(10,2)",
                 [("r", "2024-01-01 00:00:00", "a", "1"), ("r", "2024-01-02 00:00:00", "b", "2"),
                  ("r", "2024-01-02 00:00:00", "c", "3")])
    got = {r.rental_id: r.final_cost for r in extracts.extract_rentals(rows, costs).collect()}
    assert got == {"r": 3, "none": None}


def test_upsert_of_null_and_insert_ignore(make):
    target = make("id string, a string, b string", [("1", "old", "keep"), ("2", "old", "keep")])
    source = make("id string, a string, b string", [("1", None, "new"), ("3", "x", "y")])
    rows = {r.id: (r.a, r.b) for r in keys.upsert(target, source, ["id"], ["a"]).collect()}
    assert rows == {"1": (None, "keep"), "2": ("old", "keep"), "3": ("x", "y")}
    added = keys.insert_ignore(target, source, ["id"])
    assert {r.id: r.a for r in added.collect()} == {"1": "old", "2": "old", "3": "x"}


def test_partition_upsert_leaves_other_months_alone(spark, make):
    path = work_dir(spark, "test")
    rows = make("id string, v int, month_id int", [("a", 1, 202401), ("b", 1, 202402)])
    sinks.upsert_partitions(spark, path, rows, ["id"], ["v"])
    january = lambda df: {
        r[0] for r in df.filter("month_id = 202401").select(F.input_file_name()).collect()
    }
    before = january(spark.read.parquet(path))
    sinks.upsert_partitions(spark, path, make("id string, v int, month_id int", [("b", 2, 202402), ("c", 3, 202403)]),
                            ["id"], ["v"])
    after = spark.read.parquet(path)
    assert {(r.id, r.v) for r in after.collect()} == {("a", 1), ("b", 2), ("c", 3)}
    assert january(after) == before


def test_partition_upsert_meets_rows_where_they_are_written(spark, make, monkeypatch):
    """Where no key moves, old and new rows are shuffled once, by partition and slot, and a cell is one file."""
    path, moved = work_dir(spark, "test"), []
    frames = keys.upsert
    monkeypatch.setattr(sinks, "upsert", lambda *a: moved.append(frames(*a)) or moved[-1])
    hints = []
    monkeypatch.setattr(sinks, "_in_months", lambda df, part, sort, placed=False, of=sinks._in_months: (
        hints.append(placed) or of(df, part, sort, placed)))
    rows = spark.range(900).selectExpr("if(id = 7, null, cast(id as string)) as id", "1 as v",
                                       "if(id % 3 = 0, null, cast(202400 + id % 3 as int)) as month_id")
    sinks.upsert_partitions(spark, path, rows, ["id"], ["v"])
    more = rows.filter("id is null or id < 300").selectExpr("id", "2 as v", "month_id").unionByName(
        make("id string, v int, month_id int", [("new", 3, 202401)]))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    sinks.upsert_partitions(spark, path, more, ["id"], ["v"])
    plan = moved[0]._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert hints == [False, True, True]
    assert plan.count("Exchange hashpartitioning(_cell") == plan.count("Exchange ") == 2, plan
    assert plan.count("REPARTITION_BY_NUM") == 2 and "isnull" not in plan.split("Exchange hashpartitioning(_cell")[1].split("]")[0], plan
    stored = spark.read.parquet(path)
    old = {(r.id, r.v, r.month_id) for r in rows.collect()}
    new = {(r.id, r.v, r.month_id) for r in more.collect()}
    known = {r[0] for r in new}
    assert {(r.id, r.v, r.month_id) for r in stored.collect()} == new | {r for r in old if r[0] not in known}
    assert stored.count() == 901
    assert stored.filter("month_id = 202401").select(F.input_file_name()).distinct().count() == 1


def test_rows_without_a_user_wait_once(make):
    """Whatever the stations hold, a row that cannot become a fact is one waiting row."""
    rows = make("id string, user_id string, station_id string, tariff_version string, tariff_rate_per_minute decimal(10,4)",
                [("late", "u9", "s", "v", "1"), ("ok", "u", "s", "v", "1"), ("nowhere", "u", None, None, None)])
    users = make("user_id string, user_dwh_id string, is_current boolean", [("u", "U", True), ("u9", "U9", False)])
    stations = make("station_id string, station_dwh_id string", [("s", "S"), ("s", "S")])
    tariffs = make("tariff_version string, rate_per_minute decimal(10,4), tariff_dwh_id string", [("v", "1", "T")])
    looked = facts.look_up(rows, users, stations, tariffs)
    assert sorted(r.id for r in looked.filter(~facts.resolved()).collect()) == ["late", "nowhere"]
    assert [(r.id, r.station_dwh_id, r.tariff_dwh_id) for r in looked.filter(facts.resolved()).collect()] == [("ok", "S", "T")] * 2


def test_raw_loads_are_not_shuffled(spark, make, monkeypatch):
    """A RAW load is written as it comes."""
    found = []
    monkeypatch.setattr(type(make("id int", [(1,)])), "hint", lambda df, *a: found.append(a) or df)
    path = work_dir(spark, "raw")
    rows = spark.range(0, 100, 1, 3).selectExpr("id", "date'2024-01-01' as load_date")
    sinks.append_raw(rows, path)
    assert found == [] and spark.read.parquet(path).count() == 100
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() == 3


def test_partition_upsert_with_null_and_moved_partitions(spark, make):
    path, schema = work_dir(spark, "test"), "id string, v int, month_id int"
    put = lambda rows, updates: sinks.upsert_partitions(
        spark, path, make(schema, rows), ["id"], updates)
    put([("n1", 1, None), ("a", 1, 202401), ("b", 1, 202401), ("alone", 1, 202312)], ["v"])
    put([("n2", 2, None), ("a", 2, 202402), ("alone", 2, 202402)], ["v", "month_id"])
    rows = spark.read.parquet(path).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(
        [("n1", 1, None), ("n2", 2, None), ("a", 2, 202402), ("alone", 2, 202402), ("b", 1, 202401)], key=str)
    put([("b", 3, 202402)], ["v"])  # where the partition is not updated the key stays where it is
    assert {(r.id, r.v, r.month_id) for r in spark.read.parquet(path).collect()} >= {("b", 3, 202401)}


def test_older_rows_lose(make):
    schema = "id string, v string, ts int"
    target = make(schema, [("1", "new", 10), ("2", "old", 5), ("3", "none", None)])
    source = make(schema, [("1", "late", 5), ("2", "fresh", 6), ("3", "some", 1), ("4", "first", None)])
    rows = {r.id: (r.v, r.ts) for r in keys.upsert(target, source, ["id"], ["v"], ["ts"]).collect()}
    assert rows == {"1": ("new", 10), "2": ("fresh", 6), "3": ("some", 1), "4": ("first", None)}


def test_stations_are_described_later(make):
    seen = make("station_id string", [("s",), ("t",)])
    before = dims.dim_stations(seen, seen.limit(0), make("station_id string, city string", [("t", "T")]))
    later = make("station_id string, city string", [("s", "S")])
    now = dims.dim_stations(seen.limit(0), seen.limit(0), later, before).collect()
    assert {r.station_id: r.city for r in now} == {"s": "S", "t": "T"}


def test_cohorts_count_all_versions_and_stop_at_as_of(make):
    users = make("user_id string, user_dwh_id string, user_created_at timestamp, is_current boolean",
                 [("u", "v1", "2024-01-15 00:00:00", False), ("u", "v2", "2024-01-15 00:00:00", True),
                  ("later", "w", "2024-02-02 00:00:00", True)])
    rows = rentals(make, [("1", "v1", "s", 20240116, "FINISHED", 5, "10"), ("2", "v2", "s", 20240302, "FINISHED", 5, "10")])
    cohorts = marts.dm_user_cohorts(users, rows.withColumn("user_id", F.lit("u")), "2024-02-01").collect()
    assert [(r.cohort_size, r.active_month_0, int(r.avg_rentals_per_user)) for r in cohorts] == [(1, 1, 1)]


def test_marts_are_ordered_and_typed(spark, make):
    days = dims.dim_date(spark, "2024-01-01", "2024-01-03")
    rows = rentals(make, [(str(i), "u", f"s{i % 3}", 20240101 + i % 3, "FINISHED", 5, "10") for i in range(9)])
    daily = marts.dm_daily_metrics(days, rows, offers(make, []), "2024-01-03")
    assert [r.date_actual.day for r in daily.collect()] == [3, 2, 1]
    kinds = dict(daily.dtypes)
    assert kinds["total_revenue"].startswith("decimal") and kinds["date_actual"] == "date"
    stations = make("station_dwh_id string, station_id string, station_name string, city string",
                    [(f"s{i}", str(i), "n", "c") for i in range(3)])
    stats = marts.dm_station_stats(stations, rows.filter("rental_id <> '8'"), "2024-01-03")
    assert [(r.station_id, r.total_rentals_30d) for r in stats.collect()] == [("0", 3), ("1", 3), ("2", 2)]


def test_mart_versions(spark, make):
    path = work_dir(spark, "test")
    with pytest.raises(LookupError):
        sinks.read_mart(spark, "m", path)
    sinks.refresh_mart("m", make("v int", [(1,)]), path)
    reader = sinks.read_mart(spark, "m", path)
    sinks.refresh_mart("m", make("v int", [(2,)]), path)
    # A run that died after writing and before publishing.
    make("v int", [(9,)]).write.parquet(f"{path}/m/v00000003-dead")
    sinks.refresh_mart("m", make("v int", [(3,)]), path)
    assert sinks.read_mart(spark, "m", path).first().v == 3
    sinks.refresh_mart("m", make("v int", [(2,)]), path)
    assert reader.first().v == 1 and sinks.read_mart(spark, "m", path).first().v == 2


def test_calendar(spark):
    day = dims.dim_date(spark, "2024-01-06", "2024-01-07").orderBy("date_id").collect()[1]
    assert (day.date_id, day.day_of_week, day.day_name, day.week_of_year, day.is_weekend) == (
        20240107, 7, "Sunday", 1, True)
    times = dims.dim_time(spark)
    assert times.count() == 86_400 and times.select("time_id").distinct().count() == 86_400
    noon = times.filter("time_id = 175959").first()
    assert (noon.time_actual, noon.hour_of_day, noon.is_business_hours) == ("17:59:59", "12-18", True)
    assert times.filter("time_id = 180000").first().is_business_hours is False


def test_unknown_status_goes_to_quarantine(make):
    df = make("id string, status string", [("1", "ACTIVE"), ("2", "CANCELLED"), ("3", "LOST"), ("4", None)])
    known, unknown = ods.split_status(df, "offers")
    assert sorted(r.id for r in known.collect()) == ["1", "2"]
    assert sorted(r.id for r in unknown.collect()) == ["3", "4"]


def test_schema_check(make):
    df = make("user_id string, email int", [("u", 1)])
    result = {r.key: r.passed for r in quality.check_schema(df, schemas.USERS, "users").collect()}
    assert result == {"user_id": True, "email": False, "phone": False, "status": False, "created_at": False}


def test_rules_and_freshness(spark, make):
    df = make("duration_minutes int, final_cost decimal(10,2), started_at timestamp, finished_at timestamp, status string",
              [(-1, "1", "2024-01-01 00:00:00", "2024-01-01 00:00:00", "FINISHED"),
               (5, "-2", "2024-01-01 00:00:00", None, "FINISHED"),
               (None, None, "2024-01-01 00:00:00", None, "ACTIVE")])
    result = {r.key: r.observed for r in quality.check_rules(facts.add_rental_flags(df)).collect()}
    assert result == {"duration_not_negative": "1", "cost_not_negative": "1", "finished_after_started": "2"}
    raw = make("loaded_at timestamp", [("2024-01-01 10:00:00",)])
    assert quality.check_fresh(raw, "2024-01-01 11:00:00", "t").first().passed is True
    assert quality.check_fresh(raw, "2024-01-01 11:00:01", "t").first().passed is False
    assert quality.check_fresh(raw.limit(0), "2024-01-01 11:00:01", "t").first().passed is False
    assert quality.all_checks([quality.check_fresh(raw, "2024-01-01", "t")]).count() == 1


def test_unknown_role(make):
    from voltmart.operators.access import mask_pii

    with pytest.raises(ValueError):
        mask_pii(make("email string", [("a",)]), "guest")
