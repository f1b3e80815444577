"""DataMart layer. Every measure is aggregated from its fact before dimensions are joined.

Fact keys are unique (checked by quality.check_unique), so a distinct count of them is a plain
count; only users need a real distinct, which Spark pre-aggregates before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voltmart.functions.scalar import (
    as_day, date_id, date_id_in_last, days_before, exact_mean, in_last, mean_of,
    month_id, month_id_in_last, months_before, ratio,
)
from voltmart.operators.aggregates import distinct_if, exact_median, rank_desc


def _recent(fact: DataFrame, date_col: str, days: int, as_of: str) -> DataFrame:
    """Rows of the period; the month bound prunes partitions where the fact has them."""
    period = date_id_in_last(date_col, days, as_of)
    if "month_id" in fact.columns:
        period = month_id_in_last("month_id", days, as_of) & period
    return fact.filter(period)


def user_key(facts: DataFrame) -> str:
    """What tells users apart: facts carry the user beside the version, which changes over time."""
    return "user_id" if "user_id" in facts.columns else "user_dwh_id"


def dm_daily_metrics(
    dim_date: DataFrame, rentals: DataFrame, offers: DataFrame, as_of: str, days: int = 90
) -> DataFrame:
    """Thirteen measures per calendar day.

    Rentals and offers are reduced to one row per day separately and then meet on the day spine:
    joined row by row they would multiply each other and inflate every sum.
    """
    rentals = _recent(rentals, "start_date_id", days, as_of)
    offers = _recent(offers, "created_date_id", days, as_of)
    by_day = rentals.groupBy(F.col("start_date_id").alias("date_id")).agg(
        F.count("rental_id").alias("total_rentals"),
        F.count_if("is_completed").alias("completed_rentals"),
        F.count_if("is_cancelled").alias("cancelled_rentals"),
        distinct_if(user_key(rentals)).alias("active_users"),
        F.sum("final_cost").alias("total_revenue"),
        exact_mean("final_cost").alias("avg_rental_cost"),
        exact_mean("duration_minutes").alias("avg_duration_minutes"),
        F.sum("duration_minutes").alias("total_duration_minutes"),
    )
    medians = exact_median(
        rentals.select(F.col("start_date_id").alias("date_id"), "final_cost"),
        ["date_id"], "final_cost", "median_rental_cost",
    )
    offers_by_day = offers.groupBy(F.col("created_date_id").alias("date_id")).agg(
        F.count("offer_id").alias("total_offers_created"),
        F.count_if("is_used").alias("offers_used"),
        F.count_if("is_expired_unused").alias("offers_expired"),
    )
    spine_days = dim_date.filter(in_last("date_actual", days, as_of))
    return daily_view(spine_days, by_day, medians, offers_by_day).orderBy(F.desc("date_actual"))


def daily_view(
    days: DataFrame, by_day: DataFrame, medians: DataFrame, offers_by_day: DataFrame
) -> DataFrame:
    """The mart's rows of the given calendar days, from figures per day."""
    zero = ["total_rentals", "completed_rentals", "cancelled_rentals", "active_users",
            "total_offers_created", "offers_used", "offers_expired"]
    return (
        days.select("date_id", "date_actual", "year", "month_num", "day_of_week", "is_weekend")
        .join(by_day, "date_id", "left")
        .join(medians, "date_id", "left")
        .join(offers_by_day, "date_id", "left")
        .fillna(0, zero)
        .select(
            "date_actual", "year", "month_num", "day_of_week", "is_weekend",
            "total_rentals", "completed_rentals", "cancelled_rentals", "active_users",
            "total_revenue", "avg_rental_cost", "median_rental_cost",
            "avg_duration_minutes", "total_duration_minutes",
            "total_offers_created", "offers_used", "offers_expired",
            ratio(F.col("offers_used"), F.col("total_offers_created")).alias(
                "offer_to_rental_conversion_rate"
            ),
        )
    )


def popularity_rank(df: DataFrame, column: str = "total_rentals_30d") -> DataFrame:
    """Ties share a rank, gaps follow."""
    return rank_desc(df, column, "popularity_rank")


def dm_station_stats(
    dim_stations: DataFrame, rentals: DataFrame, as_of: str, keep_empty: bool = False
) -> DataFrame:
    """Thirty-day counts, revenue and usage per station, seven-day trend and rank.

    keep_empty also lists stations without rentals in the period.
    """
    week = F.col("start_date_id") >= date_id(days_before(as_of, 7))
    stats = _recent(rentals, "start_date_id", 30, as_of).groupBy("station_dwh_id").agg(
        F.count("rental_id").alias("total_rentals_30d"),
        distinct_if(user_key(rentals)).alias("unique_users_30d"),
        F.sum("final_cost").alias("total_revenue_30d"),
        exact_mean("final_cost").alias("avg_rental_cost"),
        exact_mean("duration_minutes").alias("avg_duration_minutes"),
        F.sum("duration_minutes").alias("total_usage_minutes_30d"),
        F.count_if(week).alias("rentals_last_7d"),
    )
    return station_view(dim_stations, stats, keep_empty)


def station_view(dim_stations: DataFrame, stats: DataFrame, keep_empty: bool = False) -> DataFrame:
    """The mart from figures per station_dwh_id."""
    stations = dim_stations.select("station_dwh_id", "station_id", "station_name", "city")
    joined = stations.join(stats, "station_dwh_id", "left" if keep_empty else "inner").fillna(
        0, ["total_rentals_30d", "unique_users_30d", "rentals_last_7d"]
    )
    return (
        popularity_rank(joined)
        .select(
            "station_id", "station_name", "city", "total_rentals_30d", "unique_users_30d",
            "total_revenue_30d", "avg_rental_cost", "avg_duration_minutes",
            "total_usage_minutes_30d", "rentals_last_7d", "popularity_rank",
        )
        .orderBy(F.desc("total_rentals_30d"), "station_id")
    )


def user_rental_counts(rentals: DataFrame) -> DataFrame:
    """Completed rentals and spend of each user that has any."""
    return (
        rentals.filter("is_completed")
        .groupBy("user_dwh_id")
        .agg(
            F.count(F.lit(1)).alias("total_rentals"),
            F.sum("final_cost").alias("total_spent"),
        )
    )


def dm_user_cohorts(dim_users: DataFrame, rentals: DataFrame, as_of: str) -> DataFrame:
    """Cohorts by month of registration: size, activity in month 0 and 1, averages.

    Rentals shrink to one row per user and month before they meet the users, then to one row per
    user: no user row is ever repeated, so averages over users are averages over users. Rentals of
    all versions of a user count as the user's. Nobody rents before registering, so only rentals
    from the first cohort's month up to as_of are read.
    """
    key = user_key(rentals)
    first, last = months_before(as_of, 12), as_day(as_of)
    users = dim_users.filter(
        F.col("is_current")
        & (F.col("user_created_at") >= first.cast("timestamp"))
        & (F.col("user_created_at") < F.date_add(last, 1).cast("timestamp"))
    ).select(key, F.trunc("user_created_at", "month").alias("cohort_month"))
    period = (F.col("start_date_id") >= date_id(first)) & (F.col("start_date_id") <= date_id(last))
    if "month_id" in rentals.columns:
        period = F.col("month_id").between(month_id(first), month_id(last)) & period
    rentals = rentals.filter(period)
    start_day = F.make_date(
        F.floor(F.col("start_date_id") / 10000).cast("int"),
        (F.floor(F.col("start_date_id") / 100) % 100).cast("int"),
        F.lit(1),
    )
    done = F.col("is_completed")
    monthly = rentals.groupBy(key, start_day.alias("active_month")).agg(
        F.count_if(done).alias("_done"),
        F.sum(F.when(done, F.col("final_cost"))).alias("_spent"),
    )
    per_user = (
        users.join(monthly, key, "left")
        .groupBy("cohort_month", key)
        .agg(
            F.max(F.col("active_month") == F.col("cohort_month")).alias("_in_0"),
            F.max(F.col("active_month") == F.add_months("cohort_month", 1)).alias("_in_1"),
            F.nullif(F.sum("_done"), F.lit(0)).alias("_rentals"),
            F.sum("_spent").alias("_spent"),
        )
    )
    return (
        per_user.groupBy("cohort_month")
        .agg(
            F.count(F.lit(1)).alias("cohort_size"),
            F.count_if("_in_0").alias("active_month_0"),
            F.count_if("_in_1").alias("active_month_1"),
            exact_mean("_rentals").alias("avg_rentals_per_user"),
            exact_mean("_spent").alias("avg_revenue_per_user"),
        )
        .orderBy(F.desc("cohort_month"))
    )


def dm_hourly_demand(
    rentals: DataFrame, dim_date: DataFrame, dim_time: DataFrame, as_of: str,
    keep_empty: bool = False,
) -> DataFrame:
    """Demand by hour and weekend flag over 30 days.

    The day and second dimensions have a fixed size, so broadcasting them is safe. keep_empty
    lists every hour for weekdays and weekends.
    """
    days = dim_date.select(F.col("date_id").alias("start_date_id"), "is_weekend")
    times = dim_time.select(F.col("time_id").alias("start_time_id"), "hour", "hour_of_day")
    demand = (
        _recent(rentals, "start_date_id", 30, as_of)
        .join(F.broadcast(days), "start_date_id")
        .join(F.broadcast(times), "start_time_id")
        .groupBy("hour", "hour_of_day", "is_weekend")
        .agg(
            F.count("rental_id").alias("total_rentals"),
            exact_mean("final_cost").alias("avg_cost"),
            exact_mean("duration_minutes").alias("avg_duration"),
        )
    )
    if keep_empty:
        kinds = days.select("is_weekend").distinct()
        grid = times.select("hour", "hour_of_day").distinct().crossJoin(F.broadcast(kinds))
        demand = grid.join(demand, ["hour", "hour_of_day", "is_weekend"], "left").fillna(
            0, ["total_rentals"]
        )
    return demand.orderBy("is_weekend", "hour")


def dm_revenue_breakdown(
    rentals: DataFrame, dim_date: DataFrame, dim_tariff: DataFrame, dim_stations: DataFrame,
    as_of: str,
) -> DataFrame:
    """Completed rentals by day, tariff type and city over 90 days.

    Facts are first summed per day, tariff and station, so the look-ups see the small result and a
    busy station is one row per day there. Averages are taken from the sums afterwards.
    """
    sums = (
        _recent(rentals, "start_date_id", 90, as_of)
        .filter("is_completed")
        .groupBy("start_date_id", "tariff_dwh_id", "station_dwh_id")
        .agg(
            F.count("rental_id").alias("_n"),
            F.count("final_cost").alias("_paid"),
            F.sum("final_cost").alias("_revenue"),
            F.sum("duration_minutes").alias("_minutes"),
        )
    )
    return revenue_view(sums, dim_date, dim_tariff, dim_stations)


def revenue_view(
    sums: DataFrame, dim_date: DataFrame, dim_tariff: DataFrame, dim_stations: DataFrame
) -> DataFrame:
    """The mart from sums per day, tariff and station."""
    days = dim_date.select(
        F.col("date_id").alias("start_date_id"), F.col("date_actual").alias("date")
    )
    return (
        sums.join(F.broadcast(days), "start_date_id")
        .join(dim_tariff.select("tariff_dwh_id", "tariff_type"), "tariff_dwh_id")
        .join(dim_stations.select("station_dwh_id", "city"), "station_dwh_id")
        .groupBy("date", "tariff_type", "city")
        .agg(
            F.sum("_n").alias("rentals_count"),
            F.sum("_revenue").alias("revenue"),
            mean_of(F.sum("_revenue"), F.sum("_paid")).alias("avg_revenue_per_rental"),
            F.sum("_minutes").alias("total_minutes"),
        )
        .orderBy(F.desc("date"), F.desc_nulls_first("revenue"), "tariff_type", "city")
    )


def spine(dim_date: DataFrame, days: int, as_of: str) -> DataFrame:
    return dim_date.filter(in_last("date_actual", days, as_of)).select("date_actual")


def today(dim_date: DataFrame, as_of: str) -> DataFrame:
    return dim_date.filter(F.col("date_actual") == as_day(as_of)).select("date_id", "date_actual")
