"""Pricing and offer rules over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from voltmart.schemas import (
    DEFAULT_CURRENCY, DEFAULT_SEGMENT, DEFAULT_TTL_SECONDS, GREEDY_BASE, GREEDY_MULTIPLIER,
    GREEDY_SEGMENT, GREEDY_VERSION,
)

TARIFF_FIELDS = ["tariff_id", "base_rate", "segment_multiplier", "currency", "version", "rules"]


def _greedy_tariffs(tariffs: DataFrame) -> DataFrame:
    """The dearest tariff of each station; max_by combines before the shuffle."""
    best = F.max_by(F.struct(*TARIFF_FIELDS), F.struct("base_rate", "tariff_id"))
    return tariffs.groupBy("station_id").agg(best.alias("_greedy"))


def _synthetic_greedy() -> Column:
    """Tariff used when a station has none at all."""
    values = {
        "tariff_id": F.concat(F.lit("greedy-"), F.col("station_id")),
        "base_rate": F.lit(GREEDY_BASE * GREEDY_MULTIPLIER),
        "segment_multiplier": F.lit(GREEDY_MULTIPLIER),
        "currency": F.lit(DEFAULT_CURRENCY),
        "version": F.lit(GREEDY_VERSION),
        "rules": F.create_map(F.lit("type"), F.lit("greedy")),
    }
    return F.struct(*[values[f].alias(f) for f in TARIFF_FIELDS])


def _priced(requests: DataFrame, users: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Requests with segment, greedy flag and the tariff found (NULL when there is none).

    Both tariff look-ups are plain equi joins on reduced tables; Spark broadcasts them while their
    size allows. users has one row per known user, segment NULL meaning the default.
    """
    known = users.select(
        "user_id", F.coalesce("segment", F.lit(DEFAULT_SEGMENT)).alias("_segment")
    )
    segment = F.coalesce("user_segment", "_segment")
    regular = tariffs.select(
        "station_id", F.col("segment").alias("segment"),
        F.struct(*TARIFF_FIELDS).alias("_regular"),
    )
    tariff = F.when(
        F.col("is_greedy"), F.coalesce(F.col("_greedy"), _synthetic_greedy())
    ).otherwise(F.col("_regular"))
    return (
        requests.join(known, "user_id", "left")
        .withColumn("segment", segment)
        .withColumn("is_greedy", F.col("segment").isNull())
        .join(regular, ["station_id", "segment"], "left")
        .join(_greedy_tariffs(tariffs), "station_id", "left")
        .withColumn("_tariff", tariff)
    )


def price_offers(
    requests: DataFrame, users: DataFrame, tariffs: DataFrame, ttl_seconds: int | None = None
) -> DataFrame:
    """Offers for requests (offer_id, user_id, station_id, user_segment, requested_at).

    A segment given in the request wins; otherwise the user's own. An unknown user without a
    segment is priced greedily. Requests without a regular tariff make no offer (price_rejects).
    A ttl of zero or NULL means the default.
    """
    ttl = ttl_seconds or DEFAULT_TTL_SECONDS
    snapshot = F.struct(
        "_tariff.tariff_id", "_tariff.base_rate", "_tariff.segment_multiplier",
        "_tariff.currency", "_tariff.rules",
        F.coalesce("segment", F.lit(GREEDY_SEGMENT)).alias("segment"), "is_greedy",
    )
    rate = F.col("_tariff.base_rate") * F.col("_tariff.segment_multiplier")
    created = F.unix_micros("requested_at")
    return _priced(requests, users, tariffs).filter(F.col("_tariff").isNotNull()).select(
        "offer_id", "user_id", "station_id",
        F.to_json(snapshot).alias("tariff_snapshot"),
        F.col("requested_at").alias("created_at"),
        F.timestamp_micros(created + ttl * 1_000_000).alias("expires_at"),
        F.lit("ACTIVE").alias("status"),
        F.col("_tariff.version").alias("tariff_version"),
        rate.alias("estimated_rate_per_minute"),
        F.col("_tariff.currency").alias("currency"),
    )


def price_rejects(requests: DataFrame, users: DataFrame, tariffs: DataFrame) -> DataFrame:
    """Requests of a known segment whose station has no tariff for it."""
    return _priced(requests, users, tariffs).filter(F.col("_tariff").isNull()).select(
        "offer_id", "user_id", "station_id", "segment", F.lit("TARIFF_NOT_FOUND").alias("reason")
    )


def is_valid_offer(as_of: str) -> Column:
    """ACTIVE and not yet expired; an offer expiring exactly now is expired."""
    return (F.col("status") == "ACTIVE") & (
        F.col("expires_at") > F.lit(as_of).cast("timestamp")
    )


def offer_validity(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumn("is_valid", is_valid_offer(as_of))


def active_offers(df: DataFrame, as_of: str) -> DataFrame:
    """Valid offers, newest first within each user."""
    valid = df.filter(is_valid_offer(as_of)).repartition("user_id")
    return valid.sortWithinPartitions("user_id", F.desc("created_at"), "offer_id")


def classify_offer_use(offers: DataFrame, attempts: DataFrame) -> DataFrame:
    """Outcome of each attempt (attempt_id, offer_id, user_id, ts) to use an offer.

    Checked in this order: missing or somebody else's, already used, not active, past expiry. The
    earliest attempt passing all of them uses the offer, which turns later ones into ALREADY_USED.
    The winner of an offer is one pre-aggregated row joined back by offer, so an offer drowning in
    attempts is never gathered in one place.
    """
    known = offers.select(
        "offer_id", F.col("user_id").alias("_owner"), "station_id", "status", "expires_at"
    )
    named = F.col("offer_id").isNotNull()
    tried = attempts.filter(named).join(known, "offer_id", "left")
    owned = F.coalesce(F.col("_owner") == F.col("user_id"), F.lit(False))
    usable = owned & (F.col("status") == "ACTIVE") & (F.col("ts") < F.col("expires_at"))
    order = F.struct("ts", "attempt_id")
    # `tried` has no NULL keys and winners are not filtered before: attempts have the same plan for both readers
    # and are shuffled once.
    winners = tried.groupBy("offer_id").agg(F.min(F.when(usable, order)).alias("_winner"))
    won = order == F.col("_winner")
    lost = order > F.col("_winner")
    outcome = (
        F.when(~owned, "NOT_FOUND")
        .when(F.col("status") == "USED", "ALREADY_USED")
        .when(F.col("status") != "ACTIVE", "EXPIRED")
        .when(won, "USED")
        .when(lost, "ALREADY_USED")
        .otherwise("EXPIRED")
    )
    columns = ["attempt_id", "offer_id", "user_id", "ts"]
    nameless = attempts.filter(~named).select(
        *columns, F.lit(None).cast(offers.schema["station_id"].dataType).alias("station_id"),
        F.lit("NOT_FOUND").alias("outcome"),
    )
    judged = tried.join(winners, "offer_id", "left")
    return judged.select(*columns, "station_id", outcome.alias("outcome")).union(nameless)
