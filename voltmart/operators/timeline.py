"""Ordered look-ups along a key's timeline; scan.py keeps them even where one key holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from voltmart.operators.scan import MOST, last_known, running_max, scan


def with_next(
    df: DataFrame, key: str, ts: str, tie: str, value: str, out: str, most: int = MOST
) -> DataFrame:
    """`out` = `value` of the next row of the same key by (ts, tie), NULL after the last row."""
    # Read backwards, the next row is the last one seen. The struct is never NULL, the value may be.
    backwards = [F.desc(ts), F.desc(tie)]
    found = scan(df, [key], backwards, {"_next": last_known(F.struct(value))}, inclusive=False, most=most)
    return found.withColumn(out, F.col("_next")[value]).drop("_next")


def with_prior_max(
    df: DataFrame, key: str, ts: str, tie: str, value: str, out: str, most: int = MOST
) -> DataFrame:
    """`out` = largest `value` among the earlier rows of the same key, NULL for the first row."""
    return scan(
        df, [key], [F.asc(ts), F.asc(tie)], {out: running_max(F.col(value))}, inclusive=False, most=most
    )


def first_following(
    probes: DataFrame, rows: DataFrame, key: str, at: str, after: str, ts: str, tie: str,
    picked: list[str], most: int = MOST,
) -> DataFrame:
    """Each probe with the first row of its key that follows its place on the timeline.

    Rows are ordered by (ts, tie). A probe whose `after` is NULL stands before all rows of the
    instant `at`; otherwise it stands right behind the row (at, after). `picked` columns of the row
    found are added as next_*, NULL when none follows.
    """
    carried = F.struct(*[F.col(c) for c in picked])
    marks = probes.select(
        key, F.col(at).alias("_t"), F.col(after).alias("_tie"), F.struct("*").alias("_probe"),
        F.lit(None).alias("_row"),
    )
    points = rows.select(
        key, F.col(ts).alias("_t"), F.col(tie).alias("_tie"), F.lit(None).alias("_probe"),
        carried.alias("_row"),
    )
    line = marks.unionByName(points)
    is_row = F.col("_row").isNotNull()
    backwards = [F.desc("_t"), F.desc_nulls_last("_tie"), is_row]
    found = scan(line, [key], backwards, {"_hit": last_known(F.col("_row"))}, inclusive=False, most=most)
    return found.filter(F.col("_probe").isNotNull()).select(
        "_probe.*", *[F.col(f"_hit.{c}").alias(f"next_{c}") for c in picked]
    )
