"""ODS layer: typed, de-duplicated, JSON unpacked, derived columns added."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from voltmart.functions.scalar import minutes_between, to_money
from voltmart.operators.audit import offer_status_asof
from voltmart.operators.keys import dedup_latest
from voltmart.schemas import OFFER_STATUSES, RENTAL_STATUSES, TARIFF_SNAPSHOT, USER_STATUSES

DOMAINS = {"offers": OFFER_STATUSES, "rentals": RENTAL_STATUSES, "users": USER_STATUSES}


def parse_tariff(df: DataFrame, column: str = "tariff_snapshot") -> DataFrame:
    """Unpack the tariff snapshot; effective_rate keeps base rate and multiplier apart."""
    tariff = F.from_json(column, TARIFF_SNAPSHOT)
    return (
        df.withColumn("_tariff", tariff)
        .withColumn("tariff_rate_per_minute", to_money(F.col("_tariff.base_rate")))
        .withColumn("tariff_currency", F.col("_tariff.currency"))
        .withColumn("segment_multiplier", to_money(F.col("_tariff.segment_multiplier")))
        .withColumn(
            "effective_rate",
            (F.col("tariff_rate_per_minute") * F.col("segment_multiplier")).cast("decimal(10,4)"),
        )
        .withColumn("tariff_segment", F.col("_tariff.segment"))
        .withColumn("is_greedy", F.coalesce("_tariff.is_greedy", F.lit(False)))
        .drop("_tariff")
    )


def validate_types(
    df: DataFrame, schema: T.StructType, domains: dict[str, list[str]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(typed rows, quarantined text rows).

    A row is quarantined when a value present does not fit its declared type, when a non-nullable
    field is empty, or when a value is outside its domain.
    """
    domains = domains or {}
    bad = F.lit(False)
    for field in schema.fields:
        raw = F.col(field.name)
        typed = raw.try_cast(field.dataType)
        bad = bad | (raw.isNotNull() & typed.isNull())
        if not field.nullable:
            bad = bad | raw.isNull()
        if field.name in domains:
            bad = bad | (raw.isNotNull() & ~raw.isin(domains[field.name]))
    typed_cols = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    others = [c for c in df.columns if c not in schema.names]
    return df.filter(~bad).select(*typed_cols, *others), df.filter(bad)


def split_status(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """(known, unknown) by the status domain of the table."""
    known = F.coalesce(F.col("status").isin(DOMAINS[table]), F.lit(False))
    return df.filter(known), df.filter(~known)


def incremental(src: DataFrame, since: str, column: str = "loaded_at") -> DataFrame:
    """Rows of the layer below that were loaded after `since`."""
    fresh = F.col(column) > F.lit(since).cast("timestamp")
    if "load_date" in src.columns:
        fresh = fresh & (F.col("load_date") >= F.to_date(F.lit(since)))
    return src.filter(fresh)


USER_COLUMNS = ["email", "phone", "status", "created_at"]


def ods_users(raw: DataFrame, prev: DataFrame | None, as_of: str) -> DataFrame:
    """Current users. `raw` holds full snapshots; a user missing from the newest one is deleted.

    updated_at moves only when a tracked column or the deletion flag changes. Without any snapshot
    in `raw` nobody is deleted.
    """
    newest = raw.agg(F.max("loaded_at")).scalar()
    users = (
        dedup_latest(
            raw.select("user_id", *USER_COLUMNS, "loaded_at"), ["user_id"], ["loaded_at"]
        )
        .withColumn("is_deleted", F.col("loaded_at") < newest)
        .select("user_id", *USER_COLUMNS, "is_deleted")
    )
    now = F.lit(as_of).cast("timestamp")
    if prev is None:
        return users.withColumn("updated_at", now)
    tracked = [*USER_COLUMNS, "is_deleted"]
    joined = users.alias("n").join(prev.alias("o"), "user_id", "full_outer")
    gone = F.col("n.status").isNull() & F.col("n.is_deleted").isNull()
    changed = F.lit(False)
    for name in tracked:
        changed = changed | ~F.col(f"n.{name}").eqNullSafe(F.col(f"o.{name}"))
    picked = [
        F.when(gone, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in USER_COLUMNS
    ]
    loaded = newest.isNotNull()
    deleted = F.when(gone, F.col("o.is_deleted") | loaded).otherwise(F.col("n.is_deleted"))
    moved = F.when(gone, ~F.col("o.is_deleted") & loaded).otherwise(
        changed | F.col("o.updated_at").isNull()
    )
    return joined.select(
        "user_id",
        *picked,
        deleted.alias("is_deleted"),
        F.when(moved, now).otherwise(F.col("o.updated_at")).alias("updated_at"),
    )


def ods_offers(raw: DataFrame, audit: DataFrame | None = None, as_of: str | None = None) -> DataFrame:
    """One row per offer, tariff unpacked, status brought up to date from the audit log.

    Incremental extracts follow created_at, so a later status change is only in the log.
    """
    offers = parse_tariff(dedup_latest(raw, ["offer_id"], ["loaded_at"]))
    if audit is None:
        return offers
    latest = offer_status_asof(audit, as_of).select(
        "offer_id", F.col("status").alias("_replayed")
    )
    return (
        offers.join(latest, "offer_id", "left")
        .withColumn("status", F.coalesce("_replayed", "status"))
        .drop("_replayed")
    )


def ods_rentals(raw: DataFrame, offers: DataFrame) -> DataFrame:
    """One row per rental with billing minutes, and the tariff version of its offer filled in."""
    rentals = dedup_latest(raw, ["rental_id"], ["loaded_at"])
    versions = offers.select("offer_id", F.col("tariff_version").alias("_offer_version"))
    return (
        rentals.join(versions, "offer_id", "left")
        .withColumn("tariff_version", F.coalesce("tariff_version", "_offer_version"))
        .withColumn("duration_minutes", minutes_between("started_at", "finished_at"))
        .drop("_offer_version")
    )
