"""Declared schemas of sources and layers (money as decimals, time as UTC timestamps)."""

from __future__ import annotations

from pyspark.sql import types as T

RATE = T.DecimalType(10, 4)
MONEY = T.DecimalType(10, 2)

# --- fixed values -----------------------------------------------------------------------------
OFFER_STATUSES = ["ACTIVE", "USED", "EXPIRED", "CANCELLED"]
RENTAL_STATUSES = ["PENDING", "ACTIVE", "FINISHED", "CANCELLED"]
USER_STATUSES = ["ACTIVE", "INACTIVE", "BLOCKED"]
USER_SEGMENTS = ["STANDARD", "PREMIUM", "VIP"]
DEFAULT_SEGMENT = "STANDARD"
DEFAULT_TTL_SECONDS = 300
INITIAL_FEE = "50"
GREEDY_BASE = 10.0
GREEDY_MULTIPLIER = 1.5
GREEDY_VERSION = "greedy-v1"
GREEDY_SEGMENT = "GREEDY"
DEFAULT_CURRENCY = "RUB"
OPEN_END = "9999-12-31 00:00:00"
EPOCH = "1970-01-01 00:00:00"
RETENTION_DAYS = {"raw": 30, "ods": 365, "dds": 1095, "mart": 1095}
# ----------------------------------------------------------------------------------------------


TEXT, TIME, NUMBER, FLAG = T.StringType(), T.TimestampType(), T.DoubleType(), T.BooleanType()
TEXT_MAP = T.MapType(TEXT, TEXT)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


TARIFF_SNAPSHOT = _struct(
    tariff_id=TEXT, base_rate=NUMBER, segment_multiplier=NUMBER, currency=TEXT, rules=TEXT_MAP,
    segment=TEXT, is_greedy=FLAG,
)
USERS = _struct(user_id=TEXT, email=TEXT, phone=TEXT, status=TEXT, created_at=TIME)
SEGMENTS = _struct(user_id=TEXT, segment=TEXT, updated_at=TIME)
PROFILES = _struct(user_id=TEXT, name=TEXT, extra_metadata=TEXT)
OFFERS = _struct(
    offer_id=TEXT, user_id=TEXT, station_id=TEXT, tariff_snapshot=TEXT, created_at=TIME,
    expires_at=TIME, status=TEXT, tariff_version=TEXT,
)
RENTALS = _struct(
    rental_id=TEXT, offer_id=TEXT, user_id=TEXT, station_id=TEXT, started_at=TIME,
    finished_at=TIME, status=TEXT, tariff_snapshot=TEXT, tariff_version=TEXT,
)
RENTAL_EVENTS = _struct(event_id=TEXT, rental_id=TEXT, ts=TIME, type=TEXT, payload=TEXT)
OFFER_AUDIT = _struct(id=TEXT, offer_id=TEXT, event_type=TEXT, ts=TIME, payload_json=TEXT)
COST_SNAPSHOTS = _struct(id=TEXT, rental_id=TEXT, ts=TIME, cost_amount=MONEY, details=TEXT)
PAYMENT_OUTBOX = _struct(
    id=TEXT, rental_id=TEXT, amount=T.DecimalType(18, 4), created_at=TIME, processed=FLAG
)
TARIFFS = _struct(
    tariff_id=TEXT, station_id=TEXT, segment=TEXT, base_rate=NUMBER, segment_multiplier=NUMBER,
    currency=TEXT, version=TEXT, rules=TEXT_MAP,
)
