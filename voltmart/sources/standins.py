"""Rental tables derived from the order tables the checks run on.

The mapping is fixed by FIXTURES.md: orders play offers, line items play rentals, customers play
users, suppliers play stations and the event log plays rental events. Nothing is invented here;
every row comes from a given table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmart.functions.scalar import (
    date_id, minutes_between, month_id, surrogate_key, time_id, to_money,
)
from voltmart.operators.facts import add_offer_flags, add_rental_flags
from voltmart.operators.keys import dedup_latest

ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-30"
FIRST_DAY = "1995-01-01"

MARKET_SEGMENTS = [
    "AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "STANDARD",
]
# Declared schemas: no job to infer them, and a table of another shape fails instead of surprising.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}
TIME_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def as_utc(df: DataFrame, name: str) -> DataFrame:
    """The table's naive timestamps read as UTC."""
    column = TIME_COLUMNS.get(name)
    return df if column is None else df.withColumn(column, F.col(column).cast("timestamp"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return as_utc(spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet"), name)


def _id(column: str):
    return F.col(column).cast("string")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("created_at")
    )
    customers = table(spark, sf_dir, "customer")
    return customers.join(first.hint("merge"), customers.c_custkey == first.o_custkey, "left").select(
        _id("c_custkey").alias("user_id"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.lit("ACTIVE").alias("status"),
        "created_at",
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of the users that have one: customers of the HOUSEHOLD market have none."""
    return table(spark, sf_dir, "customer").filter("c_mktsegment <> 'HOUSEHOLD'").select(
        _id("c_custkey").alias("user_id"),
        F.col("c_mktsegment").alias("segment"),
    )


def station_directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            _id("s_suppkey").alias("station_id"),
            F.col("s_name").alias("station_name"),
            F.col("n_name").alias("city"),
            F.col("r_name").alias("region"),
        )
    )


def _base_rate():
    """Rate by priority, with three rates under each version."""
    return F.substring("o_orderpriority", 1, 1).cast("double") + (F.col("o_custkey") % 3) * 0.25


def _multiplier():
    return F.lit(1.0) + (F.col("o_custkey") % 3) * 0.25


def _snapshot():
    segment = F.element_at(
        F.array(F.lit("STANDARD"), F.lit("PREMIUM"), F.lit("VIP")),
        (F.col("o_custkey") % 3).cast("int") + 1,
    )
    greedy = F.col("o_orderkey") % 50 == 0
    return F.to_json(
        F.struct(
            F.concat(F.lit("t-"), _id("o_orderpriority")).alias("tariff_id"),
            _base_rate().alias("base_rate"),
            _multiplier().alias("segment_multiplier"),
            F.lit("RUB").alias("currency"),
            F.when(greedy, F.lit("GREEDY")).otherwise(segment).alias("segment"),
            greedy.alias("is_greedy"),
        )
    )


def _plus_seconds(ts: str, seconds):
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("bigint") * 1_000_000)


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        _id("o_orderkey").alias("offer_id"),
        _id("o_custkey").alias("user_id"),
        (F.col("o_orderkey") % 100).cast("string").alias("station_id"),
        _snapshot().alias("tariff_snapshot"),
        F.col("o_orderdate").alias("created_at"),
        _plus_seconds("o_orderdate", F.lit(300)).alias("expires_at"),
        F.when(status == "F", "USED").when(status == "O", "ACTIVE").otherwise("EXPIRED").alias(
            "status"
        ),
        F.col("o_orderpriority").alias("tariff_version"),
    )


def raw_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offers(spark, sf_dir).withColumn("loaded_at", F.col("created_at"))


def _line_status():
    flag = F.col("l_returnflag")
    return (
        F.when(flag == "A", "FINISHED").when(flag == "R", "CANCELLED").otherwise("ACTIVE")
    )


def _line_cost():
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kept = F.lit(1).cast("decimal(4,2)") - F.col("l_discount").cast("decimal(4,2)")
    return (price * kept).cast("decimal(12,2)")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rental rows, repeats included; the user is still missing."""
    return _as_rentals(table(spark, sf_dir, "lineitem"))


def _as_rentals(lines: DataFrame, *more: str) -> DataFrame:
    finished = F.col("l_returnflag") == "A"
    return lines.select(
        F.concat_ws("-", _id("l_orderkey"), _id("l_linenumber")).alias("rental_id"),
        "l_orderkey",
        _id("l_orderkey").alias("offer_id"),
        _id("l_suppkey").alias("station_id"),
        F.col("l_shipdate").alias("started_at"),
        F.when(finished, _plus_seconds("l_shipdate", (F.col("l_quantity") * 60).cast("bigint")))
        .alias("finished_at"),
        _line_status().alias("status"),
        F.when(finished, _line_cost()).alias("final_cost"),
        F.col("l_shipdate").alias("loaded_at"),
        *more,
    )


def raw_rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RAW rentals with repeats; the rental itself never knows its tariff version."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), _id("o_custkey").alias("user_id"),
        _snapshot().alias("tariff_snapshot"),
    )
    return (
        _lines(spark, sf_dir)
        .join(orders, "l_orderkey")
        .withColumn("tariff_version", F.lit(None).cast("string"))
        .drop("l_orderkey")
    )


RENTAL_ORDER = ["loaded_at", "finished_at", "status", "station_id", "final_cost"]


def rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplicated rentals with user, rate and billing minutes.

    Lines are shuffled once, by their order: repeats of a rental have the same order and go before the join. A
    rental id that lacks a part is that of the other one, which then says where the line goes.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        _id("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("tariff_version"),
        _base_rate().alias("_rate"),
    )
    lines = table(spark, sf_dir, "lineitem").withColumn("_order", F.coalesce("l_orderkey", "l_linenumber"))
    lines = dedup_latest(_as_rentals(lines.repartition("_order"), "_order"), ["_order", "rental_id"], RENTAL_ORDER)
    return (
        lines.filter("l_orderkey is not null")
        .drop("l_orderkey")
        .withColumnRenamed("_order", "l_orderkey")
        .join(orders, "l_orderkey")
        .withColumn("tariff_rate_per_minute", to_money("_rate"))
        .withColumn("duration_minutes", minutes_between("started_at", "finished_at"))
        .drop("l_orderkey", "_rate")
    )


def rental_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rentals in fact shape. Users and stations keep their own ids as keys here, so a mart query
    does not repeat the dimension look-ups that fact_rentals shows."""
    return add_rental_flags(
        rentals(spark, sf_dir).select(
            "rental_id",
            F.col("user_id").alias("user_dwh_id"),
            surrogate_key("station_id").alias("station_dwh_id"),
            surrogate_key("tariff_version", "tariff_rate_per_minute").alias("tariff_dwh_id"),
            date_id("started_at").alias("start_date_id"),
            time_id("started_at").alias("start_time_id"),
            "started_at", "finished_at", "duration_minutes", "final_cost", "status",
            month_id("started_at").alias("month_id"),
        )
    )


def offer_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_offer_flags(
        offers(spark, sf_dir).select(
            "offer_id", "status", date_id("created_at").alias("created_date_id"),
            month_id("created_at").alias("month_id"),
        )
    )


def rental_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_rental_events(table(spark, sf_dir, "events"))


def as_rental_events(events: DataFrame) -> DataFrame:
    """The event log with its station, batch or streaming."""
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), _id("user_id").alias("user_id"),
        "event_type", F.col("value").cast("decimal(10,2)").alias("value"),
        F.get_json_object("props", "$.k").alias("station_id"),
    )


def event_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read as rentals, for everything that needs a time of day."""
    return as_event_facts(rental_events(spark, sf_dir))


def as_event_facts(events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind == "purchase", "FINISHED").when(kind == "error", "CANCELLED")
        .otherwise("ACTIVE")
    )
    return add_rental_flags(
        events.select(
            _id("event_id").alias("rental_id"),
            F.col("user_id").alias("user_dwh_id"),
            surrogate_key("station_id").alias("station_dwh_id"),
            date_id("ts").alias("start_date_id"),
            time_id("ts").alias("start_time_id"),
            F.col("ts").alias("started_at"),
            (F.col("event_id") % 60 + 1).cast("int").alias("duration_minutes"),
            F.col("value").alias("final_cost"),
            status.alias("status"),
            month_id("ts").alias("month_id"),
        )
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension straight from the directory."""
    return station_directory(spark, sf_dir).withColumn(
        "station_dwh_id", surrogate_key("station_id")
    )


def cost_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One snapshot per finished line; repeated lines make several snapshots of one rental."""
    return (
        table(spark, sf_dir, "lineitem")
        .filter("l_returnflag = 'A'")
        .select(
            F.concat_ws("-", _id("l_partkey"), _id("l_suppkey"), F.col("l_quantity").cast("int"))
            .alias("id"),
            F.concat_ws("-", _id("l_orderkey"), _id("l_linenumber")).alias("rental_id"),
            F.col("l_shipdate").alias("ts"),
            _line_cost().alias("cost_amount"),
        )
    )


def outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A payment per finished rental, one hour after its end; half of them processed. Every fifth
    amount is a quarter off, so that reconciliation has something to find."""
    paid = rentals(spark, sf_dir).filter("status = 'FINISHED'")
    odd = F.col("offer_id").cast("bigint")
    return paid.select(
        F.concat(F.lit("pay-"), "rental_id").alias("id"),
        "rental_id",
        (F.col("final_cost") + F.when(odd % 5 == 0, F.lit("0.25").cast("decimal(4,2)"))
         .otherwise(F.lit("0").cast("decimal(4,2)"))).cast("decimal(18,4)").alias("amount"),
        _plus_seconds("finished_at", F.lit(3600)).alias("created_at"),
        (odd % 2 == 0).alias("processed"),
    )


def offer_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creation of every offer; use after two minutes, expiry after five."""
    orders = table(spark, sf_dir, "orders")
    created = orders.select(
        F.concat(_id("o_orderkey"), F.lit("-1")).alias("id"),
        _id("o_orderkey").alias("offer_id"),
        F.lit("CREATED").alias("event_type"),
        F.col("o_orderdate").alias("ts"),
        F.to_json(F.struct(_id("o_custkey").alias("user_id"))).alias("payload_json"),
    )
    used = F.col("o_orderstatus") == "F"
    changed = orders.filter("o_orderstatus <> 'O'").select(
        F.concat(_id("o_orderkey"), F.lit("-2")).alias("id"),
        _id("o_orderkey").alias("offer_id"),
        F.lit("STATUS_CHANGED").alias("event_type"),
        _plus_seconds("o_orderdate", F.when(used, F.lit(120)).otherwise(F.lit(300))).alias("ts"),
        F.to_json(
            F.struct(
                F.lit("ACTIVE").alias("old_status"),
                F.when(used, F.lit("USED")).otherwise(F.lit("EXPIRED")).alias("new_status"),
            )
        ).alias("payload_json"),
    )
    return created.unionByName(changed)


def open_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers before any use: F was made ACTIVE again, so that attempts can win it. Every
    thirteenth has lost its station."""
    key = F.col("offer_id").cast("bigint")
    return (
        offers(spark, sf_dir)
        .withColumn(
            "status",
            F.when(key % 11 == 0, F.lit("USED"))
            .when(F.col("status") == "USED", F.lit("ACTIVE"))
            .otherwise(F.col("status")),
        )
        .withColumn("station_id", F.when(key % 13 != 0, F.col("station_id")))
    )


def use_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One attempt per line: 7 s per unit after the offer was made, so some come too late. Line 7
    is tried by somebody else; every seventeenth order is unknown to the offers."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem")
    user = F.when(F.col("l_linenumber") == 7, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    offer = F.when(F.col("o_orderkey") % 17 == 0, F.concat(F.lit("x"), _id("o_orderkey"))).otherwise(
        _id("o_orderkey")
    )
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat_ws(
            "-", _id("l_orderkey"), _id("l_linenumber"), _id("l_partkey"), _id("l_suppkey"),
            F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_quantity").cast("int"),
        ).alias("attempt_id"),
        offer.alias("offer_id"),
        user.cast("string").alias("user_id"),
        _plus_seconds("o_orderdate", (F.col("l_quantity") * 7).cast("bigint")).alias("ts"),
    )


def finishes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Return of the device: between 10 and 2,000 days after the offer, long enough for one user's
    rentals to get in each other's way. Offers of status P are never returned."""
    return table(spark, sf_dir, "orders").filter("o_orderstatus <> 'P'").select(
        _id("o_orderkey").alias("offer_id"),
        _plus_seconds("o_orderdate", (F.col("o_orderkey") % 200 + 1) * 864_000).alias("finished_at"),
    )


def finish_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A finish request per line item row. Line 6 comes from somebody else, every nineteenth order
    asks for an unknown rental."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem")
    rental = F.concat_ws("-", _id("l_orderkey"), _id("l_linenumber"))
    user = F.when(F.col("l_linenumber") == 6, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.concat_ws(
            "-", _id("l_orderkey"), _id("l_linenumber"), _id("l_partkey"), _id("l_suppkey"),
            F.date_format("l_shipdate", "yyyyMMdd"), F.col("l_quantity").cast("int"),
        ).alias("request_id"),
        F.when(F.col("o_orderkey") % 19 == 0, F.concat(F.lit("x"), rental)).otherwise(rental)
        .alias("rental_id"),
        user.cast("string").alias("user_id"),
        _plus_seconds("l_shipdate", (F.col("l_quantity") * 60).cast("bigint")).alias("ts"),
    )


def tariffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tariff per supplier and customer segment. Suppliers in debt offer none at all, and only the
    wealthier ones serve the MACHINERY segment."""
    kinds = F.array(*[F.lit(name) for name in MARKET_SEGMENTS])
    key = F.col("s_suppkey")
    return (
        table(spark, sf_dir, "supplier")
        .filter("s_acctbal >= 0")
        .withColumn("segment", F.explode(kinds))
        .filter((F.col("segment") != "MACHINERY") | (F.col("s_acctbal") > 2000))
        .select(
            F.concat_ws("-", _id("s_suppkey"), "segment").alias("tariff_id"),
            _id("s_suppkey").alias("station_id"),
            "segment",
            (F.lit(2.0) + (key % 7) * 0.5 + F.length("segment") * 0.25).alias("base_rate"),
            (F.lit(1.0) + F.length("segment") * 0.125).alias("segment_multiplier"),
            F.lit("RUB").alias("currency"),
            F.concat(F.lit("v"), (key % 3).cast("string")).alias("version"),
            F.create_map(F.lit("type"), F.lit("regular")).alias("rules"),
        )
    )


def offer_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request per order. Every eighth user is unknown, every fifth request names its segment."""
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        _id("o_orderkey").alias("offer_id"),
        F.when(key % 8 == 0, F.concat(F.lit("u"), _id("o_custkey"))).otherwise(_id("o_custkey"))
        .alias("user_id"),
        (key % 120).cast("string").alias("station_id"),
        F.when(key % 5 == 0, F.lit("MACHINERY")).alias("user_segment"),
        F.col("o_orderdate").alias("requested_at"),
    )


def known_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with their segment, NULL where they have none."""
    return table(spark, sf_dir, "customer").select(
        _id("c_custkey").alias("user_id"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("segment"),
    )
