"""Column expressions shared by all layers; every one stays inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from voltmart.schemas import INITIAL_FEE, RATE

NULL_KEY_PART = "~"


def date_id(ts) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def time_id(ts) -> Column:
    """HHMMSS as an integer."""
    return F.hour(ts) * 10000 + F.minute(ts) * 100 + F.second(ts)


def month_id(ts) -> Column:
    """YYYYMM, the partition column of the facts."""
    return F.year(ts) * 100 + F.month(ts)


def as_day(as_of: str) -> Column:
    return F.to_date(F.lit(as_of))


def days_before(as_of: str, days: int) -> Column:
    return F.date_sub(as_day(as_of), days)


def months_before(as_of: str, months: int) -> Column:
    """First day of the month `months` before the month of as_of."""
    return F.add_months(F.trunc(as_day(as_of), "month"), -months)


def in_last(column, days: int, as_of: str) -> Column:
    """Rolling period on a date column; bounded above so that future days stay out."""
    return (F.col(column) >= days_before(as_of, days)) & (F.col(column) <= as_day(as_of))


def date_id_in_last(column, days: int, as_of: str) -> Column:
    """The same period on a YYYYMMDD column; both bounds fold to literals and reach the scan."""
    return (F.col(column) >= date_id(days_before(as_of, days))) & (
        F.col(column) <= date_id(as_day(as_of))
    )


def month_id_in_last(column, days: int, as_of: str) -> Column:
    """Partition-pruning companion of date_id_in_last."""
    return (F.col(column) >= month_id(days_before(as_of, days))) & (
        F.col(column) <= month_id(as_day(as_of))
    )


def day_type(column, kind: str | None) -> Column:
    """weekday / weekend / no filter on a boolean weekend flag."""
    if kind is None:
        return F.lit(True)
    if kind not in ("weekday", "weekend"):
        raise ValueError(f"day type must be weekday or weekend, got {kind!r}")
    return F.col(column) if kind == "weekend" else ~F.col(column)


def minutes_between(start, end) -> Column:
    """Billing minutes: every started minute counts. NULL while unfinished."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.ceil(micros / F.lit(60e6)).cast("int")


def seconds_between(start, end) -> Column:
    return (F.unix_seconds(end) - F.unix_seconds(start)).cast("int")


def to_money(column, kind=RATE) -> Column:
    """Float to decimal through its text form, so binary noise never reaches a sum."""
    column = F.col(column) if isinstance(column, str) else column
    return column.cast("string").cast(kind)


def rental_charge(base_rate: Column, minutes: Column) -> Column:
    """Fee plus rate per billing minute; a missing rate counts as zero."""
    rate = F.coalesce(to_money(base_rate), F.lit("0").cast(RATE))
    fee = F.lit(INITIAL_FEE).cast("decimal(10,2)")
    return (fee + rate * minutes).cast("decimal(18,4)")


def ratio(part: Column, whole: Column, scale: int = 2) -> Column:
    """100 * part / whole, NULL for an empty whole."""
    share = F.lit(100).cast("decimal(20,0)") * part / F.nullif(whole, F.lit(0))
    return F.round(share, scale)


def mean_of(total: Column, count: Column, scale: int = 4) -> Column:
    """total / count rounded once from a long quotient; NULL for nothing."""
    quotient = total.cast("decimal(28,6)") / F.nullif(count, F.lit(0))
    return F.round(quotient, scale).cast(f"decimal(18,{scale})")


def exact_mean(column, scale: int = 4) -> Column:
    return mean_of(F.sum(column), F.count(column), scale)


def surrogate_key(*columns) -> Column:
    """Deterministic stand-in for a serial: same row, same key, on any run and any cluster."""
    parts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY_PART))
        for c in columns
    ]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def norm_email(column) -> Column:
    return F.lower(F.trim(column))


def json_field(column, path: str) -> Column:
    return F.get_json_object(column, path)


def canonical_uuid(column) -> Column:
    """Lower-case 36-character form; a bare 32-hex value is accepted."""
    raw = F.lower(F.regexp_replace(column, "-", ""))
    dash = F.lit("-")
    return F.concat(
        raw.substr(1, 8), dash, raw.substr(9, 4), dash, raw.substr(13, 4), dash,
        raw.substr(17, 4), dash, raw.substr(21, 12),
    )


def shard_of(user_id, shards: int) -> Column:
    """md5 of the raw identifier bytes, modulo the shard count.

    The digest has 128 bits, more than any Spark number, so it is reduced one 32-bit word at a
    time; with shards below 2**30 every step fits a bigint.
    """
    if not 0 < shards < 2**30:
        raise ValueError("shard count must be between 1 and 2**30")
    digest = F.md5(F.unhex(F.regexp_replace(user_id, "-", "")))
    left_over = F.lit(0).cast("bigint")
    for word in range(4):
        value = F.conv(F.substring(digest, 1 + 8 * word, 8), 16, 10).cast("bigint")
        left_over = (left_over * (2**32 % shards) + value) % shards
    return left_over.cast("int")


def calendar_cols(day) -> dict[str, Column]:
    """ISO calendar parts of a date (Monday is 1)."""
    weekday = F.weekday(day) + 1
    return {
        "date_id": date_id(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "day_of_month": F.dayofmonth(day),
        "week_of_year": F.weekofyear(day),
        "month_num": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "year": F.year(day),
        "is_weekend": weekday >= 6,
    }
