"""Fact loads: dimension look-ups, date and time keys, upsert over the previous load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voltmart.functions.scalar import date_id, month_id, seconds_between, time_id
from voltmart.operators.keys import upsert

RENTAL_UPDATES = [
    "finished_at", "end_date_id", "end_time_id", "duration_minutes", "final_cost", "status",
    "dw_updated_at", "is_completed", "is_cancelled",
]
OFFER_UPDATES = ["status", "is_used", "is_expired_unused"]
# What a fact is made of, beside its look-ups.
RENTAL_SOURCE = [
    "rental_id", "offer_id", "user_id", "station_id", "started_at", "finished_at", "duration_minutes", "final_cost",
    "status", "tariff_version", "tariff_rate_per_minute",
]
OFFER_SOURCE = [
    "offer_id", "user_id", "station_id", "created_at", "expires_at", "status", "tariff_version",
    "tariff_rate_per_minute",
]


def add_rental_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("is_completed", F.col("status") == "FINISHED").withColumn(
        "is_cancelled", F.col("status") == "CANCELLED"
    )


def add_offer_flags(df: DataFrame) -> DataFrame:
    return df.withColumn("is_used", F.col("status") == "USED").withColumn(
        "is_expired_unused", F.col("status") == "EXPIRED"
    )


def add_ttl(df: DataFrame) -> DataFrame:
    return df.withColumn("ttl_seconds", seconds_between("created_at", "expires_at"))


def effective_status(as_of: str) -> Column:
    """An ACTIVE offer past its expiry counts as EXPIRED even if nobody wrote that down."""
    lapsed = (F.col("status") == "ACTIVE") & (
        F.col("expires_at") <= F.lit(as_of).cast("timestamp")
    )
    return F.when(lapsed, F.lit("EXPIRED")).otherwise(F.col("status"))


def _with_dims(rows: DataFrame, dim_users: DataFrame, dim_stations: DataFrame) -> DataFrame:
    """Inner look-ups of user and station.

    No broadcast is forced: Spark broadcasts a dimension only while its measured size allows, and
    otherwise joins by sort-merge, where AQE splits a user or station holding too many rows.
    """
    users = dim_users.filter("is_current").select("user_id", "user_dwh_id")
    stations = dim_stations.select("station_id", "station_dwh_id")
    return rows.join(users, "user_id").join(stations, "station_id")


def _with_tariff(rows: DataFrame, dim_tariff: DataFrame) -> DataFrame:
    """Left look-up on version and rate together; the version alone would multiply facts."""
    tariffs = dim_tariff.select(
        "tariff_version", F.col("rate_per_minute").alias("tariff_rate_per_minute"),
        "tariff_dwh_id",
    )
    return rows.join(tariffs, ["tariff_version", "tariff_rate_per_minute"], "left")


def look_up(
    rows: DataFrame, dim_users: DataFrame, dim_stations: DataFrame, dim_tariff: DataFrame
) -> DataFrame:
    """Rows with the keys of their user, station and tariff, NULL where the dimension lacks them.

    A row without a user looks for no station: a station described twice makes two facts, not two waiting rows.
    """
    users = dim_users.filter("is_current").select("user_id", "user_dwh_id")
    stations = dim_stations.select(F.col("station_id").alias("_station"), "station_dwh_id")
    found = (F.col("station_id") == F.col("_station")) & F.col("user_dwh_id").isNotNull()
    return _with_tariff(rows.join(users, "user_id", "left").join(stations, found, "left").drop("_station"), dim_tariff)


def resolved() -> Column:
    """Whether a row that was looked up has what a fact needs: its user and its station."""
    return F.col("user_dwh_id").isNotNull() & F.col("station_dwh_id").isNotNull()


def rental_columns(rows: DataFrame, as_of: str) -> DataFrame:
    """Rental facts from rows that have their keys."""
    now = F.lit(as_of).cast("timestamp")
    return add_rental_flags(
        rows.select(
            "rental_id", "user_dwh_id", "user_id", "station_dwh_id",
            date_id("started_at").alias("start_date_id"),
            time_id("started_at").alias("start_time_id"),
            date_id("finished_at").alias("end_date_id"),
            time_id("finished_at").alias("end_time_id"),
            "tariff_dwh_id", "offer_id", "started_at", "finished_at", "duration_minutes",
            "final_cost", "status",
            now.alias("dw_loaded_at"), now.alias("dw_updated_at"),
            month_id("started_at").alias("month_id"),
        )
    )


def offer_columns(rows: DataFrame, as_of: str) -> DataFrame:
    """Offer facts from rows that have their keys."""
    return add_offer_flags(
        add_ttl(rows).select(
            "offer_id", "user_dwh_id", "user_id", "station_dwh_id",
            date_id("created_at").alias("created_date_id"),
            time_id("created_at").alias("created_time_id"),
            "tariff_dwh_id", "created_at", "expires_at",
            effective_status(as_of).alias("status"),
            "ttl_seconds",
            F.lit(as_of).cast("timestamp").alias("dw_loaded_at"),
            month_id("created_at").alias("month_id"),
        )
    )


def fact_rentals(
    rentals: DataFrame, dim_users: DataFrame, dim_stations: DataFrame, dim_tariff: DataFrame,
    as_of: str, prev: DataFrame | None = None,
) -> DataFrame:
    """Rental facts; `rentals` needs tariff_version and tariff_rate_per_minute.

    With `prev`, rentals already loaded take their new end, cost and status.
    """
    facts = rental_columns(_with_tariff(_with_dims(rentals, dim_users, dim_stations), dim_tariff), as_of)
    return facts if prev is None else upsert(prev, facts, ["rental_id"], RENTAL_UPDATES)


def fact_offers(
    offers: DataFrame, dim_users: DataFrame, dim_stations: DataFrame, dim_tariff: DataFrame,
    as_of: str, prev: DataFrame | None = None,
) -> DataFrame:
    """Offer facts with the status they effectively have at as_of."""
    facts = offer_columns(_with_tariff(_with_dims(offers, dim_users, dim_stations), dim_tariff), as_of)
    return facts if prev is None else upsert(prev, facts, ["offer_id"], OFFER_UPDATES)


def fact_rejects(rentals: DataFrame, dim_users: DataFrame, dim_stations: DataFrame) -> DataFrame:
    """Rentals the inner look-ups drop, with the dimension they miss."""
    users = dim_users.filter("is_current").select("user_id", F.lit(True).alias("_user"))
    stations = dim_stations.select("station_id", F.lit(True).alias("_station"))
    reason = F.when(F.col("_user").isNull(), F.lit("user")).otherwise(F.lit("station"))
    return (
        rentals.select("rental_id", "user_id", "station_id")
        .join(users, "user_id", "left")
        .join(stations, "station_id", "left")
        .filter(F.col("_user").isNull() | F.col("_station").isNull())
        .select("rental_id", "user_id", "station_id", reason.alias("missing"))
    )
