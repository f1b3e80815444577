"""Marts after several runs of an incremental load, against the SQL over the final rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voltmart.functions.scalar import date_id, month_id
from voltmart.operators.dims import dim_time
from voltmart.plans import state
from voltmart.session import cut_lineage, work_dir
from voltmart.sources import sinks, standins as src
from voltmart.suite.mart_queries import (
    AS_OF, DAILY_SQL, STATION_COLUMNS, calendar, event_calendar, tariff_dimension,
)
from voltmart.suite.registry import day, num, once_per_session, query

RUNS = ["2001-06-15", "2001-07-10", AS_OF]
EVENT_RUNS = ["2024-01-10", "2024-01-20", src.EVENTS_AS_OF]


def in_three_parts(facts: DataFrame, key: str) -> list[DataFrame]:
    """The same facts as three increments. The first has unfinished rentals without costs, some on another day,
    at another station or under another user; the later ones correct these, each a part, and bring late rows."""
    part = F.pmod(F.xxhash64(key), F.lit(10))
    early = facts
    if "start_date_id" in facts.columns:
        before = F.date_sub("started_at", 3)
        odd = part == 1
        early = (
            facts.withColumn("start_date_id", F.when(odd, date_id(before)).otherwise(F.col("start_date_id")))
            .withColumn("month_id", F.when(odd, month_id(before)).otherwise(F.col("month_id")))
            .withColumn("station_dwh_id", F.when(part == 2, F.lit("elsewhere")).otherwise(F.col("station_dwh_id")))
            .withColumn("user_dwh_id", F.when(part == 3, F.lit("someone")).otherwise(F.col("user_dwh_id")))
            .withColumn("final_cost", F.when(part < 4, F.lit(None)).otherwise(F.col("final_cost") + 1).cast(
                facts.schema["final_cost"].dataType))
            .withColumn("duration_minutes", F.when(part > 2, F.col("duration_minutes")))
            .withColumn("is_completed", part == 5)
        )
    else:
        early = facts.withColumn("status", F.lit("ACTIVE"))
    early = early.select(*facts.columns)
    return [
        early.filter(part < 7),
        facts.filter(part.isin(0, 2, 4, 6, 7)),
        facts.filter(part.isin(1, 3, 5, 8, 9)),
    ]


def load(spark, root: str, name: str, key: str, rows: DataFrame, as_of: str) -> DataFrame:
    """One run's upsert, all columns following the source; returns its signed changes. Parts are row by row those of a
    written table and read from it each time."""
    log = (state.run_id(as_of), f"{root}/changes/{name}")
    updates = [c for c in rows.columns if c != key]
    sinks.upsert_partitions(
        spark, f"{root}/dds/{name}", rows, [key], updates, log=log, log_columns=state.log_columns(rows, key),
        written=True,
    )
    return sinks.changes_of(spark, log)


@once_per_session
def delta_marts(spark, sf: str) -> tuple[str, dict[str, str]]:
    """Where the warehouse lies after three runs, and where each mart does."""
    root, since, paths = work_dir(spark, "deltas"), "1970-01-01", {}
    stations, tariffs = src.stations(spark, sf), tariff_dimension(spark, sf)
    # The three parts come from one reading of the source.
    rentals = in_three_parts(cut_lineage(src.rental_facts(spark, sf), "facts"), "rental_id")
    offers = in_three_parts(src.offer_facts(spark, sf).drop("is_used", "is_expired_unused"), "offer_id")
    for as_of, more_rentals, more_offers in zip(RUNS, rentals, offers):
        changes = [
            load(spark, root, "fact_rentals", "rental_id", more_rentals, as_of),
            load(spark, root, "fact_offers", "offer_id", more_offers, as_of),
        ]
        paths = state.refresh(
            spark, root, calendar(spark), dim_time(spark), stations, tariffs, *changes, as_of, since
        )
        since = as_of
    return root, paths


@once_per_session
def delta_demand(spark, sf: str) -> str:
    root = work_dir(spark, "deltas")
    visits = src.event_facts(spark, sf).withColumn("tariff_dwh_id", F.lit(None).cast("string"))
    for as_of, more in zip(EVENT_RUNS, in_three_parts(visits, "rental_id")):
        state.add_changes(spark, root, as_of, load(spark, root, "fact_visits", "rental_id", more, as_of), None)
    view = state.hourly_demand(spark, root, event_calendar(spark), dim_time(spark), src.EVENTS_AS_OF)
    return sinks.refresh_mart("dm_hourly_demand", view, f"{root}/mart")


@query("delta_daily_metrics", DAILY_SQL, "daily")
def _(spark, sf):
    return spark.read.parquet(delta_marts(spark, sf)[1]["dm_daily_metrics"])


@query("delta_station_stats", f"SELECT {STATION_COLUMNS} FROM station_stats", "station_stats")
def _(spark, sf):
    return spark.read.parquet(delta_marts(spark, sf)[1]["dm_station_stats"])


@query("delta_revenue_breakdown", f"""
SELECT {day('date')} AS date, tariff_type, city, rentals_count, {num('revenue')} AS revenue,
       avg_revenue_per_rental, CAST(total_minutes AS BIGINT) AS total_minutes
FROM breakdown""", "breakdown")
def _(spark, sf):
    return spark.read.parquet(delta_marts(spark, sf)[1]["dm_revenue_breakdown"])


@query("delta_hourly_demand", "SELECT * FROM hourly", "hourly")
def _(spark, sf):
    return spark.read.parquet(delta_demand(spark, sf))


PERIOD_SQL = """SELECT CAST(d AS INTEGER) AS period_days, {figures}
FROM rentals, (VALUES (7), (30), (90)) AS p(d)
WHERE started_at >= TIMESTAMP '2001-08-01' - d * INTERVAL 1 DAY AND started_at < TIMESTAMP '2001-08-02' GROUP BY 1"""


@query("period_users", PERIOD_SQL.format(
    figures="count(DISTINCT user_id) AS users, true AS within_two_percent"), "rentals")
def _(spark, sf):
    found = state.period_users(spark, delta_marts(spark, sf)[0], AS_OF)
    gap = F.abs(F.col("estimated_users") - F.col("users"))
    return found.select("period_days", "users", (gap * 50 <= F.col("users")).alias("within_two_percent"))


@query("period_medians", PERIOD_SQL.format(
    figures="round(quantile_cont(CAST(final_cost AS DOUBLE), 0.5), 3) AS median_rental_cost"), "rentals")
def _(spark, sf):
    return state.period_medians(spark, delta_marts(spark, sf)[0], AS_OF)
