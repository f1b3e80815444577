"""The refresh from sources to marts, by increments.

Each layer is written and read back before the next one, so a lost executor costs one layer at most
and every layer can be rebuilt from the one below. A run handles what arrived since the last one:
ODS and facts rewrite only the days (or months) it touches, the user dimension gains versions, and only
the marts, which are small, are written whole. A first run is an increment onto nothing.

What arrives in the wrong order is kept until its counterpart comes, so that runs over parts of the
sources end where one run over all of them does: costs and status changes of rentals and offers not
yet known, facts of users not yet known, and rentals whose offer has not arrived.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voltmart.functions.scalar import date_id, minutes_between, month_id
from voltmart.operators import facts, quality
from voltmart.operators.audit import status_changes
from voltmart.operators.dims import (
    dim_date, dim_stations, dim_tariff, dim_time, new_user_versions, scd2_merge,
)
from voltmart.operators.keys import dedup_latest, latest_per_key
from voltmart.operators.ods import incremental, ods_users, parse_tariff, split_status
from voltmart.plans import marts, state
from voltmart import schemas
from voltmart.schemas import EPOCH, RETENTION_DAYS
from voltmart.session import cut_lineage, hashed_joins, scratch, together
from voltmart.sources import extracts, shards, sinks

RAW_COLUMNS = ["loaded_at", "load_date", "source_system"]
TARIFF_COLUMNS = [
    "tariff_rate_per_minute", "tariff_currency", "segment_multiplier", "effective_rate",
    "tariff_segment", "is_greedy",
]


@dataclass(frozen=True)
class Grain:
    """Partition columns of ODS and facts, and how ODS derives its own from the row's time."""

    ods: str
    rentals: str
    offers: str
    of: Callable[[str], Column]


# For warehouses whose months are small.
MONTHLY = Grain("month_id", "month_id", "month_id", month_id)
DAILY = Grain("day_id", "start_date_id", "created_date_id", date_id)


MARTS = [
    "dm_daily_metrics", "dm_station_stats", "dm_user_cohorts", "dm_hourly_demand", "dm_revenue_breakdown",
]


@dataclass
class Sources:
    """What a run extracts: all users, and the offers, rentals, cost snapshots, audit rows and rental
    events that are new or have changed since the run before, in any order across runs."""

    users: DataFrame
    segments: DataFrame
    offers: DataFrame
    rentals: DataFrame
    cost_snapshots: DataFrame
    offer_audit: DataFrame
    stations: DataFrame
    rental_events: DataFrame | None = None


def load_raw_layer(src: Sources, root: str, as_of: str) -> None:
    tables = {
        "users": (extracts.extract_users(src.users, src.segments), "user_service"),
        "offers": (src.offers, "offer_service"),
        "rentals": (src.rentals, "rental_service"),
        "cost_snapshots": (extracts.extract_events(src.cost_snapshots), "rental_service"),
        "offer_audit": (extracts.extract_events(src.offer_audit), "offer_service"),
    }
    if src.rental_events is not None:
        tables["rental_events"] = (extracts.extract_events(src.rental_events), "rental_service")
    together(src.offers.sparkSession, *[
        partial(sinks.append_raw, extracts.load_raw(df, system, as_of), f"{root}/raw/{name}")
        for name, (df, system) in tables.items()
    ])


def _waiting(spark: SparkSession, root: str, name: str, like: DataFrame) -> DataFrame:
    """Rows that earlier runs could not place yet."""
    held = sinks.read_version(spark, name, f"{root}/waiting")
    return like.limit(0) if held is None else held


def _keep_waiting(rows: DataFrame, root: str, name: str) -> None:
    sinks.refresh_mart(name, rows, f"{root}/waiting")


def _trusted(df: DataFrame, name: str, key: str, root: str) -> DataFrame:
    """Rows with a key and, for offers and rentals, a known status; the others go to quarantine. A user
    with an odd status stays: one missing from a snapshot would count as deleted."""
    good, bad = split_status(df, name) if name in ("offers", "rentals") else (df, df.filter("false"))
    bad = bad.unionByName(good.filter(F.col(key).isNull()))
    if not bad.isEmpty():
        bad.write.partitionBy("load_date").mode("append").parquet(f"{root}/quarantine/{name}")
    return good.filter(F.col(key).isNotNull())


def _of_partitions(known: DataFrame, ids: DataFrame, key: str, part_col: str) -> DataFrame:
    """Whole rows of the given keys, read from the partitions that hold them: a projection of key and
    partition finds those."""
    parts = [row[0] for row in ids.select(part_col).distinct().collect()]
    inside = F.col(part_col).isin([p for p in parts if p is not None])
    if None in parts:
        inside = F.coalesce(inside, F.lit(False)) | F.col(part_col).isNull()
    return known.filter(inside).join(ids.select(key), key, "left_semi")


def _offer_increment(
    spark: SparkSession, raw: DataFrame, audit: DataFrame, root: str, as_of: str, grain: Grain
) -> DataFrame:
    """New and re-extracted offers, and known ones with a newer status in the audit log.

    An offer's status is that of its latest change up to as_of, whichever run brought it; an offer
    without any keeps the status it was extracted with. `_held` is the partition where a known offer lies.
    """
    log = status_changes(audit)
    log = cut_lineage(log.unionByName(_waiting(spark, root, "offer_audit", log)), "changes")
    due = F.col("ts") <= F.lit(as_of).cast("timestamp")
    newest = F.when(due, F.struct("ts", "id"))
    arrived = F.coalesce(due, F.lit(True))
    latest = log.filter(arrived).groupBy("offer_id").agg(
        F.max_by("status", newest).alias("_status"), F.max(newest).alias("_since")
    )
    # Tariffs are unpacked at the end, so that no shuffle carries them twice.
    new = dedup_latest(raw, ["offer_id"], ["loaded_at"]).drop(*RAW_COLUMNS).withColumn(
        grain.ods, grain.of("created_at")
    )
    known = sinks.read_if_present(spark, f"{root}/ods/offers")
    if known is None:
        none = lambda kind: F.lit(None).cast(kind)
        before = new.select(
            "offer_id", none("string").alias("_old"), none("struct<ts:timestamp,id:string>").alias("_old_since"),
            F.struct(grain.ods).alias("_held"),
        ).limit(0)
    else:
        known = known.withColumn(grain.ods, F.col(grain.ods).cast(new.schema[grain.ods].dataType))
        before = known.select(
            "offer_id", F.col("status").alias("_old"), F.col("status_since").alias("_old_since"),
            F.struct(grain.ods).alias("_held"),
        )
    stamp = F.lit(as_of).cast("timestamp")
    later = F.col("_since").isNotNull() & (
        F.col("_old_since").isNull() | (F.col("_since") > F.col("_old_since"))
    )
    fresh = (
        new.join(latest, "offer_id", "left")
        .join(before, "offer_id", "left")
        .withColumn(
            "status",
            F.when(later, F.col("_status"))
            .when(F.col("_old_since").isNotNull(), F.col("_old"))
            .otherwise(F.col("status")),
        )
        .withColumn("status_since", F.when(later, F.col("_since")).otherwise(F.col("_old_since")))
        .withColumn("updated_at", stamp)
        .drop("_status", "_since", "_old", "_old_since")
    )
    fresh = parse_tariff(fresh)
    met = None
    if known is not None:
        held = known.select("offer_id", F.col("status_since").alias("_old_since"), grain.ods)
        # All known offers of the log that do not come with this run, those that change among them.
        met = cut_lineage(
            held.join(latest, "offer_id").join(raw.select("offer_id"), "offer_id", "left_anti"), "met"
        )
        moved = met.filter(later)
        changed = (
            _of_partitions(known, moved, "offer_id", grain.ods)
            .join(moved.select("offer_id", "_status", "_since"), "offer_id")
            .withColumn("status", F.col("_status"))
            .withColumn("status_since", F.col("_since"))
            .withColumn("updated_at", stamp)
            .withColumn("_held", F.struct(grain.ods))
            .drop("_status", "_since")
        )
        fresh = fresh.unionByName(changed)
    fresh = cut_lineage(fresh, "offers")
    placed = fresh.select("offer_id") if met is None else fresh.select("offer_id").union(met.select("offer_id"))
    # Changes of offers not seen yet, and those dated after this run.
    waiting = log.filter(arrived).join(placed, "offer_id", "left_anti").unionByName(log.filter(~arrived))
    _keep_waiting(waiting, root, "offer_audit")
    return fresh


def _rental_increment(
    spark: SparkSession, raw: DataFrame, costs: DataFrame, offers: DataFrame, root: str, as_of: str,
    grain: Grain,
) -> DataFrame:
    """New and re-extracted rentals, and known ones whose cost or whose offer has arrived.

    The cost is that of the latest snapshot, whichever run brought it. Version and rate are the
    rental's own where it has a tariff snapshot, else those of its offer. `_held` is the partition where a known
    rental lies.
    """
    columns = ["rental_id", "ts", "id", "cost_amount"]
    log = costs.select(*columns)
    log = cut_lineage(
        latest_per_key(
            log.unionByName(_waiting(spark, root, "cost_snapshots", log)), ["rental_id"], ["ts", "id"]
        ),
        "costs",
    )
    rows = dedup_latest(raw, ["rental_id"], ["loaded_at"]).drop(*RAW_COLUMNS)
    none = lambda kind: F.lit(None).cast(kind)
    if "tariff_snapshot" in rows.columns:
        own = parse_tariff(rows).drop(*[c for c in TARIFF_COLUMNS if c != "tariff_rate_per_minute"])
        rows = own.drop("tariff_snapshot")
    else:
        rows = rows.withColumn("tariff_rate_per_minute", none("decimal(10,4)"))
    rows = (
        rows.withColumn("duration_minutes", minutes_between("started_at", "finished_at"))
        .withColumn("updated_at", F.lit(as_of).cast("timestamp"))
        .withColumn(grain.ods, grain.of("started_at"))
    )
    known = sinks.read_if_present(spark, f"{root}/ods/rentals")
    if known is None:
        kept = {"final_cost": "decimal(10,2)", "cost_since": "struct<ts:timestamp,id:string>"}
        stored = rows.select(
            "rental_id", *[none(kind).alias(c) for c, kind in kept.items()], F.struct(grain.ods).alias("_held")
        ).limit(0)
    else:
        known = known.withColumn(grain.ods, F.col(grain.ods).cast(rows.schema[grain.ods].dataType))
        stored = known.select("rental_id", "final_cost", "cost_since", F.struct(grain.ods).alias("_held"))
    touched = rows.join(stored, "rental_id", "left")
    if known is not None:
        slim = known.select("rental_id", "offer_id", grain.ods, F.col("tariff_version").isNull().alias("_open"))
        by_cost = slim.join(log.select("rental_id"), "rental_id", "left_semi")
        by_offer = slim.filter("_open").join(offers.select("offer_id").distinct(), "offer_id", "left_semi")
        again = cut_lineage(
            by_cost.unionByName(by_offer)
            .select("rental_id", grain.ods)
            .join(raw.select("rental_id"), "rental_id", "left_anti"),
            "rentals_again",
        )
        old = _of_partitions(known, again, "rental_id", grain.ods).withColumn("_held", F.struct(grain.ods))
        touched = touched.unionByName(old.withColumn("updated_at", F.lit(as_of).cast("timestamp")))
    newer = F.col("ts").isNotNull() & (
        F.col("cost_since").isNull() | (F.struct("ts", "id") > F.col("cost_since"))
    )
    tariffs = spark.read.parquet(f"{root}/ods/offers").select(
        "offer_id", F.col("tariff_version").alias("_version"), F.col("tariff_rate_per_minute").alias("_rate")
    )
    bare = F.col("tariff_rate_per_minute").isNull()
    priced = (
        touched.join(log.withColumn("_costed", F.lit(True)), "rental_id", "left")
        .withColumn("final_cost", F.when(newer, F.col("cost_amount")).otherwise(F.col("final_cost")))
        .withColumn("cost_since", F.when(newer, F.struct("ts", "id")).otherwise(F.col("cost_since")))
        .drop("ts", "id", "cost_amount")
        .join(tariffs, "offer_id", "left")
        .withColumn("tariff_version", F.coalesce("tariff_version", "_version"))
        .withColumn("tariff_rate_per_minute", F.when(bare, F.col("_rate")).otherwise(F.col("tariff_rate_per_minute")))
        .drop("_version", "_rate")
    )
    priced = cut_lineage(priced, "rentals")
    # A cost of a known rental brings it here, so what no row here has met waits.
    placed = priced.filter("_costed").select("rental_id")
    _keep_waiting(log.join(placed, "rental_id", "left_anti"), root, "cost_snapshots")
    return priced.drop("_costed")


def _store_increment(
    spark: SparkSession, df: DataFrame, path: str, key: str, part_col: str
) -> DataFrame:
    """Upsert whole rows of a written table, which name the partition that holds them in `_held`; returns the rows
    of the increment as they were stored."""
    columns = [c for c in df.columns if c not in (key, "_held")]
    return sinks.upsert_partitions(
        spark, path, df, [key], columns, part_col, written=True, held_col="_held", staged=False
    )


def load_ods_layer(
    spark: SparkSession, root: str, since: str, as_of: str, grain: Grain = MONTHLY
) -> dict[str, DataFrame]:
    """Returns the increment of each ODS table."""
    keys = {"users": "user_id", "offers": "offer_id", "rentals": "rental_id", "cost_snapshots": "rental_id"}
    trusted = lambda name, key: _trusted(
        incremental(spark.read.parquet(f"{root}/raw/{name}"), since), name, key, root
    )
    fresh = dict(zip(keys, together(spark, *[partial(trusted, *pair) for pair in keys.items()])))
    audit = incremental(spark.read.parquet(f"{root}/raw/offer_audit"), since)

    def offers_and_rentals() -> dict[str, DataFrame]:
        offers = _store_increment(
            spark, _offer_increment(spark, fresh["offers"], audit, root, as_of, grain),
            f"{root}/ods/offers", "offer_id", grain.ods,
        )
        rentals = _store_increment(
            spark,
            _rental_increment(spark, fresh["rentals"], fresh["cost_snapshots"], offers, root, as_of, grain),
            f"{root}/ods/rentals", "rental_id", grain.ods,
        )
        return {"offers": offers, "rentals": rentals}

    def users() -> None:
        known = sinks.read_version(spark, "users", f"{root}/ods")
        sinks.refresh_mart("users", ods_users(fresh["users"], known, as_of), f"{root}/ods")

    return together(spark, offers_and_rentals, users)[0]


def change_log(root: str, name: str, as_of: str) -> tuple[str, str]:
    """Where a run publishes the signed changes of a fact."""
    return state.run_id(as_of), f"{root}/changes/{name}"


def _load_fact(
    spark: SparkSession, rows: DataFrame, name: str, key: str, dims: list[DataFrame], shape,
    updates: list[str], part_col: str, root: str, log: tuple[str, str] | None = None,
) -> None:
    """Upsert a fact's increment and the rows that earlier runs could not resolve; what still lacks a
    dimension row waits for the next run. Dimensions are looked up once, for the rows that become facts and
    for those that wait."""
    with scratch(spark, name):
        held = _waiting(spark, root, name, rows).select(*rows.columns)
        rows = rows.unionByName(held.join(rows.select(key), key, "left_anti"))
        looked = cut_lineage(facts.look_up(rows, *dims), "looked")
        fact = shape(looked.filter(facts.resolved()))
        sinks.upsert_partitions(
            spark, f"{root}/dds/{name}", fact, [key], updates, part_col, "station_dwh_id",
            log=log, log_columns=state.log_columns(fact, key), written=True, staged=False,
        )
        _keep_waiting(looked.filter(~facts.resolved()).select(*rows.columns), root, name)


def load_star(
    spark: SparkSession, changed: dict[str, DataFrame], stations: DataFrame, root: str, as_of: str,
    grain: Grain = MONTHLY, deltas: bool = False,
) -> None:
    """Dimensions first, each a new published version; then the increments of the facts."""
    logged = lambda name: change_log(root, name, as_of) if deltas else None
    dds = f"{root}/dds"
    users = sinks.read_version(spark, "users", f"{root}/ods")
    known = {
        name: sinks.read_version(spark, name, dds)
        for name in ("dim_users", "dim_stations", "dim_tariff")
    }
    fresh = {
        "dim_users": new_user_versions(users, EPOCH) if known["dim_users"] is None
        else scd2_merge(known["dim_users"], users, as_of),
        "dim_stations": dim_stations(changed["offers"], changed["rentals"], stations, known["dim_stations"]),
        "dim_tariff": dim_tariff(changed["offers"], known["dim_tariff"]),
    }
    together(spark, *[partial(sinks.refresh_mart, name, df, dds) for name, df in fresh.items()])
    dims = [sinks.read_version(spark, n, dds) for n in ("dim_users", "dim_stations", "dim_tariff")]
    together(
        spark,
        lambda: _load_fact(
            spark, changed["rentals"].select(*facts.RENTAL_SOURCE), "fact_rentals", "rental_id", dims,
            lambda looked: facts.rental_columns(looked, as_of), [*facts.RENTAL_UPDATES, "tariff_dwh_id"],
            grain.rentals, root, logged("fact_rentals"),
        ),
        lambda: _load_fact(
            spark, changed["offers"].select(*facts.OFFER_SOURCE), "fact_offers", "offer_id", dims,
            lambda looked: facts.offer_columns(looked, as_of), facts.OFFER_UPDATES, grain.offers, root,
            logged("fact_offers"),
        ),
    )


def check_layers(spark: SparkSession, root: str, start: str, as_of: str) -> DataFrame:
    """Run the checks of a refresh and append what they find, with its time, to the results table.

    Facts against dimensions, business rules, unique keys, and the daily mart against facts and
    calendar; quarantined and waiting rows are reported by their number.
    """
    dds = f"{root}/dds"
    rentals = spark.read.parquet(f"{dds}/fact_rentals")
    daily = sinks.read_mart(spark, "dm_daily_metrics", f"{root}/mart")
    days = daily.select(F.date_format("date_actual", "yyyyMMdd").cast("int").alias("start_date_id"))
    in_mart = rentals.join(days, "start_date_id", "left_semi")
    found = [
        quality.check_fk(rentals, sinks.read_version(spark, name, dds), key, "fact_rentals")
        for name, key in (
            ("dim_users", "user_dwh_id"), ("dim_stations", "station_dwh_id"), ("dim_tariff", "tariff_dwh_id"),
        )
    ]
    found.append(quality.check_rules(rentals))
    found.append(quality.check_unique(rentals, ["rental_id"], "fact_rentals"))
    found.append(quality.check_unique(spark.read.parquet(f"{dds}/fact_offers"), ["offer_id"], "fact_offers"))
    found.append(
        quality.check_totals(
            daily, in_mart,
            {"total_rentals": F.count("rental_id"), "total_revenue": F.sum("final_cost")}, "dm_daily_metrics",
        )
    )
    found.append(
        quality.check_dates(daily, marts.spine(dim_date(spark, start, as_of), 90, as_of), "dm_daily_metrics")
    )
    for name in ("users", "offers", "rentals", "cost_snapshots"):
        bad = sinks.read_if_present(spark, f"{root}/quarantine/{name}")
        if bad is not None:
            found.append(quality.check_empty(bad, "quarantine", name))
    for name in ("fact_rentals", "fact_offers", "cost_snapshots", "offer_audit"):
        found.append(quality.check_empty(sinks.read_version(spark, name, f"{root}/waiting"), "waiting", name))
    results = quality.all_checks(found).withColumn("checked_at", F.lit(as_of).cast("timestamp"))
    results.write.mode("append").parquet(f"{root}/dq")
    return spark.read.parquet(f"{root}/dq").filter(F.col("checked_at") == F.lit(as_of).cast("timestamp"))


def archive_layers(spark: SparkSession, root: str, as_of: str, grain: Grain = MONTHLY) -> None:
    """Move what is past its layer's retention to the archive: RAW days, and partitions of ODS and facts (days, or
    months whose last day is past it), which become empty; old versions of dimensions and marts, of which the
    published one always stays."""
    for name in ("users", "offers", "rentals", "cost_snapshots", "offer_audit", "rental_events"):
        table = sinks.read_if_present(spark, f"{root}/raw/{name}")
        if table is not None:
            sinks.archive_partitions(
                spark, table, f"{root}/raw/{name}", f"{root}/archive/raw/{name}", "load_date",
                RETENTION_DAYS["raw"], as_of,
            )
    for layer, name, column in (
        ("ods", "offers", grain.ods), ("ods", "rentals", grain.ods),
        ("dds", "fact_rentals", grain.rentals), ("dds", "fact_offers", grain.offers),
    ):
        table = sinks.read_if_present(spark, f"{root}/{layer}/{name}")
        if table is not None:
            sinks.archive_partitions(
                spark, table, f"{root}/{layer}/{name}", f"{root}/archive/{layer}/{name}", column,
                RETENTION_DAYS[layer], as_of,
            )
    for layer, names in (("ods", ["users"]), ("dds", ["dim_users", "dim_stations", "dim_tariff"]), ("mart", MARTS)):
        for name in names:
            sinks.archive_versions(
                spark, name, f"{root}/{layer}", f"{root}/archive/{layer}", RETENTION_DAYS[layer], as_of
            )


def expire_open_offers(offers: DataFrame, as_of: str) -> DataFrame:
    """Offer facts as of a time: one left open beyond its expiry counts as expired from then on,
    even when no later increment touches it."""
    return facts.add_offer_flags(offers.withColumn("status", facts.effective_status(as_of)))


def refresh_marts_by_delta(
    spark: SparkSession, root: str, start: str, as_of: str, since: str
) -> dict[str, str]:
    """The marts from the state that the changes of all runs add up to (see state.py). Cohorts look back over
    a year of every user's months and are computed whole."""
    dds = f"{root}/dds"
    users, stations, tariffs = [
        sinks.read_version(spark, n, dds) for n in ("dim_users", "dim_stations", "dim_tariff")
    ]
    changes = [
        sinks.changes_of(spark, change_log(root, name, as_of)) for name in ("fact_rentals", "fact_offers")
    ]
    paths = state.refresh(
        spark, root, dim_date(spark, start, as_of), dim_time(spark), stations, tariffs, *changes, as_of, since
    )
    cohorts = marts.dm_user_cohorts(users, spark.read.parquet(f"{dds}/fact_rentals"), as_of)
    return paths | {"dm_user_cohorts": sinks.refresh_mart("dm_user_cohorts", cohorts, f"{root}/mart")}


def refresh_marts(spark: SparkSession, root: str, start: str, as_of: str) -> dict[str, str]:
    dds = f"{root}/dds"
    users, stations, tariffs = [
        sinks.read_version(spark, n, dds) for n in ("dim_users", "dim_stations", "dim_tariff")
    ]
    rentals = spark.read.parquet(f"{dds}/fact_rentals")
    offers = expire_open_offers(spark.read.parquet(f"{dds}/fact_offers"), as_of)
    days = dim_date(spark, start, as_of)
    views = {
        "dm_daily_metrics": lambda: marts.dm_daily_metrics(days, rentals, offers, as_of),
        "dm_station_stats": lambda: marts.dm_station_stats(stations, rentals, as_of),
        "dm_user_cohorts": lambda: marts.dm_user_cohorts(users, rentals, as_of),
        "dm_hourly_demand": lambda: marts.dm_hourly_demand(rentals, days, dim_time(spark), as_of),
        "dm_revenue_breakdown": lambda: marts.dm_revenue_breakdown(rentals, days, tariffs, stations, as_of),
    }
    publish = lambda name, view: sinks.refresh_mart(name, view(), f"{root}/mart")
    return dict(zip(views, together(spark, *[partial(publish, *pair) for pair in views.items()])))


def refresh_warehouse(
    spark: SparkSession, src: Sources, root: str, start: str, as_of: str, since: str = EPOCH,
    grain: Grain = MONTHLY, checked: bool = False, deltas: bool = False,
) -> dict[str, str]:
    """One run; `since` is the as_of of the run before, `grain` stays the same for all runs.
    Returns where each mart was written. A run has to be later than the one before: rows it loads at
    `since` would count as handled. `checked` runs the checks and stores what they find. With `deltas`, for
    all runs or none, marts are kept up by the changes of the facts instead of being computed from them."""
    if not spark.range(1).select(F.lit(as_of).cast("timestamp") > F.lit(since).cast("timestamp")).first()[0]:
        raise ValueError(f"a run as of {as_of} cannot follow one as of {since}")
    with scratch(spark, "refresh"), hashed_joins(spark):
        load_raw_layer(src, root, as_of)
        changed = load_ods_layer(spark, root, since, as_of, grain)
        load_star(spark, changed, src.stations, root, as_of, grain, deltas)
        if deltas:
            paths = refresh_marts_by_delta(spark, root, start, as_of, since)
        else:
            paths = refresh_marts(spark, root, start, as_of)
        if checked:
            check_layers(spark, root, start, as_of)
    return paths


# The column of each sharded table that says when a row came or was changed last.
SHARD_MARKS = {
    "offers": ("OFFERS", "created_at"), "rentals": ("RENTALS", "started_at"),
    "cost_snapshots": ("COST_SNAPSHOTS", "ts"), "offer_audit": ("OFFER_AUDIT", "ts"),
}


def refresh_from_shards(
    spark: SparkSession, path: str, users: DataFrame, segments: DataFrame, stations: DataFrame, root: str,
    start: str, as_of: str, marks: dict[str, str] | None = None, **options,
) -> dict[str, str]:
    """One run over what the shards below path/<table> have gained since the last good run, up to as_of.

    The warehouse itself knows how far it is (see shards.py): no run passes the period on to the next. A run that fails
    commits no mark and is repeated over the same period, which changes nothing that it had done. `marks` names other mark
    columns, such as one of changes. Rows that reach a shard with a mark older than the last run are not seen.
    """
    since = shards.last_mark(spark, root)
    names = {table: (marks or {}).get(table, mark) for table, (_, mark) in SHARD_MARKS.items()}
    found = {
        table: shards.read_shards(
            spark, f"{path}/{table}", getattr(schemas, SHARD_MARKS[table][0]), mark, since, as_of
        ).drop("shard_id")
        for table, mark in names.items()
    }
    sources = Sources(users=users, segments=segments, stations=stations, **found)
    paths = refresh_warehouse(spark, sources, root, start, as_of, since=since, **options)
    shards.commit_mark(spark, root, as_of)
    return paths


def user_dimension(users: DataFrame) -> DataFrame:
    """Current user versions for marts that need only the key and the registration time."""
    return users.select(
        F.col("user_id").alias("user_dwh_id"), F.col("created_at").alias("user_created_at"),
        F.lit(True).alias("is_current"),
    )
