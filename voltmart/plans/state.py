"""Marts kept up by signed deltas instead of scans of the facts.

An upsert into a fact publishes, before it swaps partitions in, what it changes: the old row with sign
-1, the new one with +1. Four small tables add these up: sums per day, hour, station, tariff and
completion; rentals per day, station and user; rentals per day and cost; offers per day, status and expiry.
Sums and counts move by their difference, the median is read from the histogram of costs, distinct users
are those whose count is above zero. Rows that are corrected or move to another day take their old
contribution back.

A table of state is a base and one delta per run, both named by pointers; a run that is repeated replaces
its own delta, so nothing is added twice, and `compact` folds deltas into a new base. Files are sorted by
day, so that the days a mart needs are found by the statistics of row groups.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from voltmart.functions.scalar import date_id, date_id_in_last, days_before, in_last, mean_of
from voltmart.operators.aggregates import distinct_if, exact_median
from voltmart.plans import marts
from voltmart.session import cut_lineage, together
from voltmart.sources import sinks

MONEY = "decimal(28,4)"
PERIODS = (7, 30, 90)
SKETCH_BITS = 15  # registers of a day's sketch, as a power of two: a standard error of 0.6 %


@dataclass(frozen=True)
class State:
    """Keys, the day first, and the columns that add up; `n` is zero where nothing is left."""

    keys: list[str]
    sums: list[str]


STATES = {
    "rental_sums": State(
        ["start_date_id", "hour", "station_dwh_id", "tariff_dwh_id", "is_completed"],
        ["n", "cancelled", "paid", "revenue", "timed", "minutes"],
    ),
    "rental_users": State(["start_date_id", "station_dwh_id", "user_key"], ["n"]),
    "rental_costs": State(["start_date_id", "final_cost"], ["n"]),
    "offer_sums": State(["created_date_id", "status", "expires_at"], ["n"]),
}
# What the log of changes has to hold, beside the key.
RENTAL_COLUMNS = [
    "start_date_id", "start_time_id", "station_dwh_id", "tariff_dwh_id", "final_cost", "duration_minutes",
    "is_completed", "is_cancelled",
]
OFFER_COLUMNS = ["created_date_id", "status", "expires_at"]


def log_columns(fact: DataFrame, key: str) -> list[str]:
    wanted = RENTAL_COLUMNS + [marts.user_key(fact)] if "start_date_id" in fact.columns else OFFER_COLUMNS
    return [key, *[c for c in wanted if c in fact.columns]]


def _signed(value: Column) -> Column:
    return F.when(F.col("_sign") < 0, -value).otherwise(value)


def rental_deltas(changes: DataFrame) -> dict[str, DataFrame]:
    """What signed rental rows add to each table of state, in ranges of days. Keys are so fine that sums before a
    shuffle hardly shrink the rows, so these are brought to their range at once and summed there."""
    has = lambda c: F.when(F.col(c).isNotNull(), F.col("_sign")).otherwise(0).cast("bigint")
    total = lambda column, kind="bigint": F.sum(F.coalesce(column, F.lit(0))).cast(kind)
    count = F.sum(F.col("_sign").cast("bigint"))
    hour = F.floor(F.col("start_time_id") / 10000).cast("int")
    changes = changes.repartitionByRange("start_date_id")
    sums = changes.withColumn("hour", hour).groupBy(*STATES["rental_sums"].keys).agg(
        count.alias("n"),
        total(_signed(F.col("is_cancelled").cast("int")).cast("bigint")).alias("cancelled"),
        total(has("final_cost")).alias("paid"),
        total(_signed(F.col("final_cost")).cast(MONEY), MONEY).alias("revenue"),
        total(has("duration_minutes")).alias("timed"),
        total(_signed(F.col("duration_minutes")).cast("bigint")).alias("minutes"),
    )
    users = changes.withColumn("user_key", F.col(marts.user_key(changes))).groupBy(
        *STATES["rental_users"].keys
    ).agg(count.alias("n"))
    costs = changes.filter(F.col("final_cost").isNotNull()).groupBy(*STATES["rental_costs"].keys).agg(
        count.alias("n")
    )
    return {"rental_sums": sums, "rental_users": users, "rental_costs": costs}


def offer_deltas(changes: DataFrame) -> dict[str, DataFrame]:
    """Only offers still open keep their expiry: it decides when they begin to count as expired. Few rows are left
    of a day, and these are brought to ranges of days."""
    expires = F.col("expires_at") if "expires_at" in changes.columns else F.lit(None).cast("timestamp")
    open_until = F.when(F.col("status") == "ACTIVE", expires)
    counts = changes.withColumn("expires_at", open_until).groupBy(*STATES["offer_sums"].keys).agg(
        F.sum(F.col("_sign").cast("bigint")).alias("n")
    )
    return {"offer_sums": counts.repartitionByRange("created_date_id")}


def _publish(name: str, rows: DataFrame, root: str, run: str, base: bool) -> None:
    """Store rows that lie in ranges of days."""
    spark, path = rows.sparkSession, f"{root}/state/{name}"
    version = (_pointers(spark, root, name).agg(F.max("version")).first()[0] or 0) + 1
    target = f"{path}/{run}-{uuid.uuid4().hex[:8]}"
    day = STATES[name].keys[0]
    changed = rows.filter(" or ".join(f"{c} <> 0" for c in STATES[name].sums))
    changed.sortWithinPartitions(day).write.parquet(target)
    pointer = spark.createDataFrame([(run, base, version, target)], POINTER)
    pointer.coalesce(1).write.mode("append").parquet(f"{path}/pointers")


POINTER = "run string, base boolean, version bigint, location string"


def _pointers(spark: SparkSession, root: str, name: str) -> DataFrame:
    found = sinks.read_if_present(spark, f"{root}/state/{name}/pointers")
    return spark.createDataFrame([], POINTER) if found is None else found


def _live(spark: SparkSession, root: str, name: str) -> list[str]:
    """The last base and, of every later run, the delta published last."""
    pointers = _pointers(spark, root, name)
    base = pointers.filter("base").orderBy(F.desc("version")).first()
    if base is not None:
        pointers = pointers.filter(F.col("run") > base["run"])
    newest = Window.partitionBy("run").orderBy(F.desc("version"))
    deltas = pointers.filter("not base").withColumn("_place", F.row_number().over(newest)).filter("_place = 1")
    found = [row["location"] for row in deltas.select("location").collect()]
    return found if base is None else [base["location"], *found]


def read_state(spark: SparkSession, root: str, name: str, where: Column | None = None) -> DataFrame:
    """A table of state, of the rows that meet a condition on its keys."""
    state = STATES[name]
    live = _live(spark, root, name)
    if not live:
        raise LookupError(f"no state of {name} below {root}: rebuild it from the facts")
    stored = spark.read.parquet(*live)
    if where is not None:
        stored = stored.filter(where)
    kinds = {f.name: f.dataType for f in stored.schema}
    sums = [F.sum(c).cast(kinds[c]).alias(c) for c in state.sums]
    return stored.groupBy(*state.keys).agg(*sums).filter("n <> 0")


def run_id(as_of: str) -> str:
    """Runs are named by their time, in an order that text has too."""
    digits = "".join(c for c in as_of if c.isdigit())
    return digits.ljust(20, "0")


def add_changes(
    spark: SparkSession, root: str, as_of: str, rentals: DataFrame | None, offers: DataFrame | None
) -> None:
    """Add a run's signed changes of either fact to the state. Repeating it changes nothing."""
    deltas = ({} if rentals is None else rental_deltas(rentals)) | ({} if offers is None else offer_deltas(offers))
    together(spark, *[
        partial(_publish, name, rows, root, run_id(as_of), False) for name, rows in deltas.items()
    ])


def rebuild(spark: SparkSession, root: str, as_of: str, rentals: DataFrame, offers: DataFrame) -> None:
    """A new base from whole facts, for a warehouse that kept no state so far."""
    once = lambda fact: fact.withColumn("_sign", F.lit(1))
    for name, rows in (rental_deltas(once(rentals)) | offer_deltas(once(offers))).items():
        _publish(name, rows, root, run_id(as_of), base=True)


def compact(spark: SparkSession, root: str, as_of: str) -> None:
    """Fold the deltas of all runs up to as_of, the last one, into a new base. They are ignored from then on."""
    for name in STATES:
        rows = read_state(spark, root, name).repartitionByRange(STATES[name].keys[0])
        _publish(name, rows, root, run_id(as_of), base=True)


def _known(part: Column, count: Column) -> Column:
    """A sum that is NULL where nothing was summed."""
    return F.when(count > 0, part)


def daily_metrics(
    spark: SparkSession, root: str, dim_date: DataFrame, as_of: str, days: int = 90, only: list[int] | None = None
) -> DataFrame:
    """dm_daily_metrics from the state; `only` names the days (date_id) that are wanted."""
    def inside(column: str) -> Column:
        period = date_id_in_last(column, days, as_of)
        return period if only is None else period & F.col(column).isin(only)

    per_day = F.col("start_date_id").alias("date_id")
    by_day = read_state(spark, root, "rental_sums", inside("start_date_id")).groupBy(per_day).agg(
        F.sum("n").alias("total_rentals"),
        F.coalesce(F.sum(F.when(F.col("is_completed"), F.col("n"))), F.lit(0)).alias("completed_rentals"),
        F.sum("cancelled").alias("cancelled_rentals"),
        _known(F.sum("revenue"), F.sum("paid")).alias("total_revenue"),
        mean_of(F.sum("revenue"), F.sum("paid")).alias("avg_rental_cost"),
        mean_of(F.sum("minutes"), F.sum("timed")).alias("avg_duration_minutes"),
        _known(F.sum("minutes"), F.sum("timed")).alias("total_duration_minutes"),
    )
    users = read_state(spark, root, "rental_users", inside("start_date_id")).groupBy(per_day).agg(
        distinct_if("user_key").alias("active_users")
    )
    medians = exact_median(
        read_state(spark, root, "rental_costs", inside("start_date_id")).withColumnRenamed("start_date_id", "date_id"),
        ["date_id"], "final_cost", "median_rental_cost", weight="n",
    )
    status, n = F.col("status"), F.col("n")
    lapsed = (status == "ACTIVE") & (F.col("expires_at") <= F.lit(as_of).cast("timestamp"))
    counted = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    offers = read_state(spark, root, "offer_sums", inside("created_date_id")).groupBy(
        F.col("created_date_id").alias("date_id")
    ).agg(
        F.sum("n").alias("total_offers_created"),
        counted(status == "USED").alias("offers_used"),
        counted((status == "EXPIRED") | lapsed).alias("offers_expired"),
    )
    spine = dim_date.filter(in_last("date_actual", days, as_of))
    if only is not None:
        spine = spine.filter(F.col("date_id").isin(only))
    return marts.daily_view(spine, by_day.join(users, "date_id", "left"), medians, offers)


def station_stats(spark: SparkSession, root: str, dim_stations: DataFrame, as_of: str) -> DataFrame:
    inside = date_id_in_last("start_date_id", 30, as_of)
    week = F.col("start_date_id") >= date_id(days_before(as_of, 7))
    sums = read_state(spark, root, "rental_sums", inside).groupBy("station_dwh_id").agg(
        F.sum("n").alias("total_rentals_30d"),
        _known(F.sum("revenue"), F.sum("paid")).alias("total_revenue_30d"),
        mean_of(F.sum("revenue"), F.sum("paid")).alias("avg_rental_cost"),
        mean_of(F.sum("minutes"), F.sum("timed")).alias("avg_duration_minutes"),
        _known(F.sum("minutes"), F.sum("timed")).alias("total_usage_minutes_30d"),
        F.coalesce(F.sum(F.when(week, F.col("n"))), F.lit(0)).alias("rentals_last_7d"),
    )
    users = read_state(spark, root, "rental_users", inside).groupBy("station_dwh_id").agg(
        distinct_if("user_key").alias("unique_users_30d")
    )
    return marts.station_view(dim_stations, cut_lineage(sums.join(users, "station_dwh_id"), "stations"))


def hourly_demand(spark: SparkSession, root: str, dim_date: DataFrame, dim_time: DataFrame, as_of: str) -> DataFrame:
    days = dim_date.select(F.col("date_id").alias("start_date_id"), "is_weekend")
    hours = dim_time.select("hour", "hour_of_day").distinct()
    return (
        read_state(spark, root, "rental_sums", date_id_in_last("start_date_id", 30, as_of))
        .join(F.broadcast(days), "start_date_id")
        .join(F.broadcast(hours), "hour")
        .groupBy("hour", "hour_of_day", "is_weekend")
        .agg(
            F.sum("n").alias("total_rentals"),
            mean_of(F.sum("revenue"), F.sum("paid")).alias("avg_cost"),
            mean_of(F.sum("minutes"), F.sum("timed")).alias("avg_duration"),
        )
        .orderBy("is_weekend", "hour")
    )


def revenue_breakdown(
    spark: SparkSession, root: str, dim_date: DataFrame, dim_tariff: DataFrame, dim_stations: DataFrame, as_of: str
) -> DataFrame:
    """Stations and tariffs are looked up now, so that what is learnt about them later shows on all days."""
    done = date_id_in_last("start_date_id", 90, as_of) & F.col("is_completed")
    sums = read_state(spark, root, "rental_sums", done).groupBy("start_date_id", "tariff_dwh_id", "station_dwh_id").agg(
        F.sum("n").alias("_n"), F.sum("paid").alias("_paid"),
        _known(F.sum("revenue"), F.sum("paid")).alias("_revenue"), _known(F.sum("minutes"), F.sum("timed")).alias("_minutes"),
    )
    return marts.revenue_view(sums, dim_date, dim_tariff, dim_stations)


def touched_days(
    spark: SparkSession, root: str, dim_date: DataFrame, rentals: DataFrame | None, offers: DataFrame | None,
    since: str, as_of: str, days: int = 90,
) -> list[int]:
    """Days of the period whose daily row may differ from that of the run at `since`: those of changed rows,
    those with offers that ran out meanwhile, and those that were not over then. At most the period's days."""
    at, before = [F.lit(x).cast("timestamp") for x in (as_of, since)]
    lapsed = (F.col("status") == "ACTIVE") & (F.col("expires_at") > before) & (F.col("expires_at") <= at)
    found = read_state(spark, root, "offer_sums", lapsed).select(F.col("created_date_id").alias("date_id"))
    for changes, column in ((rentals, "start_date_id"), (offers, "created_date_id")):
        if changes is not None:
            found = found.union(changes.select(column))
    found = found.union(dim_date.filter(F.col("date_actual") >= F.to_date(F.lit(since))).select("date_id"))
    return [r[0] for r in found.filter(date_id_in_last("date_id", days, as_of)).distinct().collect()]


def refresh_daily(
    spark: SparkSession, root: str, dim_date: DataFrame, rentals: DataFrame | None, offers: DataFrame | None,
    as_of: str, since: str, days: int = 90,
) -> str:
    """Publish dm_daily_metrics: touched days are computed from the state, the others are those of the
    version published last."""
    before = sinks.read_version(spark, "dm_daily_metrics", f"{root}/mart")
    if before is None:
        view = daily_metrics(spark, root, dim_date, as_of, days)
    else:
        touched = touched_days(spark, root, dim_date, rentals, offers, since, as_of, days)
        kept = before.filter(in_last("date_actual", days, as_of)).filter(~date_id("date_actual").isin(touched))
        fresh = daily_metrics(spark, root, dim_date, as_of, days, touched)
        view = kept.select(*fresh.columns).unionByName(fresh)
    return sinks.refresh_mart("dm_daily_metrics", view.orderBy(F.desc("date_actual")), f"{root}/mart")


def refresh_user_sketches(
    spark: SparkSession, root: str, dim_date: DataFrame, rentals: DataFrame | None, as_of: str, since: str,
    days: int = 90,
) -> str:
    """Publish day_users: a mergeable sketch of each day's users. Sketches cannot forget a user, so those of
    touched days are made anew from the rentals per day and user, the others are kept."""
    before = sinks.read_version(spark, "day_users", f"{root}/mart")
    period = date_id_in_last("start_date_id", days, as_of)
    if before is not None:
        touched = touched_days(spark, root, dim_date, rentals, None, since, as_of, days)
        period = period & F.col("start_date_id").isin(touched)
    users = read_state(spark, root, "rental_users", period).filter(F.col("user_key").isNotNull())
    fresh = users.groupBy(F.col("start_date_id").alias("date_id")).agg(
        F.hll_sketch_agg("user_key", F.lit(SKETCH_BITS)).alias("users")
    )
    if before is not None:
        kept = before.filter(date_id_in_last("date_id", days, as_of)).filter(~F.col("date_id").isin(touched))
        fresh = kept.unionByName(fresh)
    return sinks.refresh_mart("day_users", fresh, f"{root}/mart")


def period_users(spark: SparkSession, root: str, as_of: str, periods: tuple[int, ...] = PERIODS) -> DataFrame:
    """Distinct users of the last days, per period: the estimate of the merged day sketches, which reads one row
    per day, and the exact figure, one row per user of the longest period from the state."""
    last = read_state(spark, root, "rental_users", date_id_in_last("start_date_id", max(periods), as_of))
    last = last.filter(F.col("user_key").isNotNull()).groupBy("user_key").agg(F.max("start_date_id").alias("day"))
    sketches = sinks.read_mart(spark, "day_users", f"{root}/mart")
    def per_period(rows: DataFrame, figure, out: str) -> DataFrame:
        """One row aggregated into a column per period, turned into a row per period."""
        row = rows.agg(*[figure(d).alias(f"d{d}") for d in periods])
        return row.select(F.inline(F.array(*[
            F.struct(F.lit(d).alias("period_days"), F.col(f"d{d}").alias(out)) for d in periods
        ])))

    exact = per_period(last, lambda d: F.count_if(F.col("day") >= date_id(days_before(as_of, d))), "users")
    merged = lambda d: F.hll_union_agg(F.when(date_id_in_last("date_id", d, as_of), F.col("users")))
    estimates = per_period(
        sketches, lambda d: F.coalesce(F.hll_sketch_estimate(merged(d)), F.lit(0)), "estimated_users"
    )
    return exact.join(estimates, "period_days")


def period_medians(spark: SparkSession, root: str, as_of: str, periods: tuple[int, ...] = PERIODS) -> DataFrame:
    """Exact median cost of the last days, per period: the stored histograms of the days are added up, and only
    the coarse cell that holds the middle is looked into."""
    costs = read_state(spark, root, "rental_costs", date_id_in_last("start_date_id", max(periods), as_of))
    within = F.filter(
        F.array(*[F.lit(d) for d in periods]),
        lambda d: F.element_at(
            F.create_map(*[x for p in periods for x in (F.lit(p), date_id(days_before(as_of, p)))]), d
        ) <= F.col("start_date_id"),
    )
    spread = costs.groupBy("start_date_id", "final_cost").agg(F.sum("n").alias("n")).select(
        "final_cost", "n", F.explode(within).alias("period_days")
    )
    return exact_median(spread, ["period_days"], "final_cost", "median_rental_cost", weight="n")


def refresh(
    spark: SparkSession, root: str, dim_date: DataFrame, dim_time: DataFrame, dim_stations: DataFrame,
    dim_tariff: DataFrame, rentals: DataFrame | None, offers: DataFrame | None, as_of: str, since: str,
) -> dict[str, str]:
    """Add a run's changes to the state and publish the four marts that follow from it, and the day sketches.
    No fact is read."""
    add_changes(spark, root, as_of, rentals, offers)
    path = f"{root}/mart"
    publish = lambda name, view: sinks.refresh_mart(name, view, path)
    jobs = {
        "dm_daily_metrics": lambda: refresh_daily(spark, root, dim_date, rentals, offers, as_of, since),
        "dm_station_stats": lambda: publish("dm_station_stats", station_stats(spark, root, dim_stations, as_of)),
        "dm_hourly_demand": lambda: publish(
            "dm_hourly_demand", hourly_demand(spark, root, dim_date, dim_time, as_of)
        ),
        "dm_revenue_breakdown": lambda: publish(
            "dm_revenue_breakdown", revenue_breakdown(spark, root, dim_date, dim_tariff, dim_stations, as_of)
        ),
        "day_users": lambda: refresh_user_sketches(spark, root, dim_date, rentals, as_of, since),
    }
    paths = dict(zip(jobs, together(spark, *jobs.values())))
    del paths["day_users"]
    return paths
