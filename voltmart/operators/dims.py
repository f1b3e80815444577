"""Dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from voltmart.functions.scalar import calendar_cols, surrogate_key
from voltmart.operators.keys import close_intervals
from voltmart.operators.scan import MOST, last_known, scan
from voltmart.schemas import OPEN_END

FEW_VERSIONS = 64  # of a key, up to which a fact may meet all of them
TRACKED_USER_COLUMNS = ["email", "phone", "status"]


def dim_date(
    spark: SparkSession, start: str, end: str, holidays: DataFrame | None = None
) -> DataFrame:
    """One row per calendar day from start to end; `holidays` has a column date_actual."""
    span = F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    days = spark.range(1).select(F.explode(span).alias("date_actual"))
    days = days.select("date_actual", *[c.alias(n) for n, c in calendar_cols("date_actual").items()])
    if holidays is None:
        return days.withColumn("is_holiday", F.lit(False))
    marked = holidays.select("date_actual").distinct().withColumn("is_holiday", F.lit(True))
    return days.join(marked, "date_actual", "left").withColumn(
        "is_holiday", F.coalesce("is_holiday", F.lit(False))
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """One row per second of the day: 86,400 rows, always."""
    second = F.col("id")
    hour, minute = F.floor(second / 3600), F.floor(second / 60) % 60
    band = F.floor(hour / 6) * 6
    two = lambda part: F.lpad(part.cast("string"), 2, "0")
    return spark.range(86_400).select(
        (hour * 10000 + minute * 100 + second % 60).cast("int").alias("time_id"),
        F.concat_ws(":", two(hour), two(minute), two(second % 60)).alias("time_actual"),
        hour.cast("int").alias("hour"),
        minute.cast("int").alias("minute"),
        F.concat_ws("-", two(band), two(band + 6)).alias("hour_of_day"),
        ((hour >= 9) & (hour < 18)).alias("is_business_hours"),
    )


def dim_stations(
    offers: DataFrame, rentals: DataFrame, reference: DataFrame | None = None,
    prev: DataFrame | None = None,
) -> DataFrame:
    """Every station seen in offers or rentals, enriched from a station directory if there is one.

    Each input is reduced to its distinct stations before the union. Stations in `prev` stay, so a
    load has to show only its new rows; what the directory knows of them now replaces what it did
    not know before, and a station it has dropped keeps its last description.
    """
    seen = (
        offers.select("station_id").distinct()
        .union(rentals.select("station_id").distinct())
        .filter(F.col("station_id").isNotNull())
    )
    if prev is not None:
        seen = seen.union(prev.select("station_id"))
    seen = seen.distinct()
    stations = seen.withColumn("station_dwh_id", surrogate_key("station_id"))
    columns = {
        "station_name": "string", "city": "string", "region": "string",
        "latitude": "decimal(10,8)", "longitude": "decimal(11,8)",
    }
    if reference is not None:
        known = [c for c in columns if c in reference.columns]
        stations = stations.join(reference.select("station_id", *known), "station_id", "left")
    for name, kind in columns.items():
        value = F.col(name) if name in stations.columns else F.lit(None)
        stations = stations.withColumn(name, value.cast(kind))
    stations = stations.select("station_dwh_id", "station_id", *columns)
    if prev is None:
        return stations
    before = prev.select("station_id", *[F.col(c).alias(f"_{c}") for c in columns])
    return stations.join(before, "station_id", "left").select(
        "station_dwh_id", "station_id",
        *[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) for c in columns],
    )


def tariff_type(is_greedy, segment):
    """standard / premium / greedy by name, anything else is a promo tariff."""
    return (
        F.when(is_greedy, F.lit("greedy"))
        .when(F.lower(segment).isin("standard", "premium"), F.lower(segment))
        .otherwise(F.lit("promo"))
    )


def dim_tariff(offers: DataFrame, prev: DataFrame | None = None) -> DataFrame:
    """Distinct (version, rate) pairs of ODS offers with type and validity interval.

    One partial aggregation keeps the earliest description of each pair, so the result has one row
    per pair whatever the snapshots hold. The interval of a pair ends where the next pair of the same
    version begins. With `prev`, new offers are enough: the pairs known so far join in.
    """
    described = ["valid_from", "tariff_type", "currency", "tariff_snapshot"]
    catalogue = offers.filter(F.col("tariff_version").isNotNull()).select(
        "tariff_version",
        F.col("tariff_rate_per_minute").alias("rate_per_minute"),
        F.col("created_at").alias("valid_from"),
        tariff_type(F.col("is_greedy"), F.col("tariff_segment")).alias("tariff_type"),
        F.col("tariff_currency").alias("currency"),
        "tariff_snapshot",
    )
    if prev is not None:
        catalogue = catalogue.unionByName(prev.select(*catalogue.columns))
    pairs = (
        catalogue.groupBy("tariff_version", "rate_per_minute")
        .agg(F.min(F.struct(*described)).alias("_first"))
        .select("tariff_version", "rate_per_minute", "_first.*")
    )
    return close_intervals(
        pairs.withColumn("tariff_dwh_id", surrogate_key("tariff_version", "rate_per_minute")),
        ["tariff_version"],
        ["rate_per_minute"],
    )


def new_user_versions(users: DataFrame, as_of: str) -> DataFrame:
    """Users as open SCD2 rows starting at as_of."""
    start = F.lit(as_of).cast("timestamp")
    return users.select(
        surrogate_key("user_id", F.unix_micros(start)).alias("user_dwh_id"),
        "user_id",
        *TRACKED_USER_COLUMNS,
        F.col("created_at").alias("user_created_at"),
        start.alias("valid_from"),
        F.lit(OPEN_END).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_merge(
    dim: DataFrame, src: DataFrame, as_of: str, tracked: list[str] | None = None
) -> DataFrame:
    """SCD type 2 in one pass: close changed rows, add new versions, keep everything else.

    Only current rows meet the source; history passes through. Change is NULL-safe, so a phone
    number that appears or disappears makes a version. as_of must not precede an open valid_from:
    such a row fails the query instead of making a negative interval.
    """
    tracked = tracked or TRACKED_USER_COLUMNS
    at = F.lit(as_of).cast("timestamp")
    history = dim.filter(~F.col("is_current"))
    open_rows = dim.filter("is_current").withColumn(
        "valid_from",
        F.when(
            F.col("valid_from") > at,
            F.raise_error(F.lit(f"as_of {as_of} precedes an open version")).cast("timestamp"),
        ).otherwise(F.col("valid_from")),
    )
    incoming = new_user_versions(src, as_of)
    joined = open_rows.alias("o").join(
        incoming.alias("n"), F.col("o.user_id") == F.col("n.user_id"), "full_outer"
    )
    is_old, is_new = F.col("o.user_id").isNotNull(), F.col("n.user_id").isNotNull()
    differs = F.lit(False)
    for name in tracked:
        differs = differs | ~F.col(f"o.{name}").eqNullSafe(F.col(f"n.{name}"))
    changed = is_old & is_new & differs
    columns = dim.columns

    def version(side: str, close: bool):
        fields = []
        for name in columns:
            value = F.col(f"{side}.{name}")
            if close and name == "valid_to":
                value = F.when(changed, at).otherwise(value)
            if close and name == "is_current":
                value = F.when(changed, F.lit(False)).otherwise(value)
            fields.append(value.alias(name))
        return F.struct(*fields)

    versions = F.array_compact(
        F.array(
            F.when(is_old, version("o", close=True)),
            F.when(is_new & (~is_old | changed), version("n", close=False)),
        )
    )
    merged = joined.select(F.explode(versions).alias("_row")).select("_row.*")
    return history.unionByName(merged)


def asof_dim(
    fact: DataFrame, dim: DataFrame, key: str, ts: str, picked: list[str], most: int = MOST
) -> DataFrame:
    """Dimension columns of the version valid at the fact's time; NULL when none was.

    Versions of a key must not overlap; one with an empty interval is never found. Where no key has more than
    FEW_VERSIONS, facts are joined with the versions of their key. Otherwise versions and facts stand in one line by
    time, and the last version is carried along it, which is linear in both even where one key has most of
    them (see scan.py).
    """
    start = F.col("valid_from")
    if dim.groupBy(key).count().filter((F.col("count") > FEW_VERSIONS) & F.col(key).isNotNull()).isEmpty():
        versions = dim.select(
            F.col(key).alias("_key"), start.alias("_from"), F.col("valid_to").alias("_to"), *picked
        )
        at = F.col(ts)
        valid = (F.col(key) == F.col("_key")) & (F.col("_from") <= at) & (at < F.col("_to"))
        return fact.join(versions, valid, "left").drop("_key", "_from", "_to")
    line = fact.select(
        F.col(key).alias("_key"), F.col(ts).alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast("timestamp").alias("_until"), F.struct("*").alias("_fact"), F.lit(None).alias("_version"),
    ).unionByName(
        dim.filter(F.col(key).isNotNull() & start.isNotNull()).select(
            F.col(key).alias("_key"), start.alias("_at"), F.lit(0).alias("_kind"),
            F.col("valid_to").alias("_until"), F.lit(None).alias("_fact"),
            F.struct(F.col("valid_to").alias("_until"), *picked).alias("_version"),
        )
    )
    order = [F.asc("_at"), F.asc("_kind"), F.asc("_until")]
    found = scan(line, ["_key"], order, {"_hit": last_known(F.col("_version"))}, most=most)
    valid = F.col("_at") < F.col("_hit._until")
    return found.filter("_kind = 1").select(
        "_fact.*", *[F.when(valid, F.col(f"_hit.{c}")).alias(c) for c in picked]
    )
