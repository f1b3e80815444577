"""From operational tables to RAW: full, incremental and enriched extracts, shard handling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from voltmart.functions.scalar import shard_of
from voltmart.operators.keys import latest_per_key
from voltmart.schemas import DEFAULT_SEGMENT, EPOCH


def extract_users(users: DataFrame, segments: DataFrame) -> DataFrame:
    """Full user snapshot with the segment; users without one are STANDARD."""
    return users.join(segments.select("user_id", "segment"), "user_id", "left").select(
        "user_id",
        "email",
        "phone",
        F.coalesce("segment", F.lit(DEFAULT_SEGMENT)).alias("segment"),
        "status",
        "created_at",
    )


def high_water_mark(target: DataFrame, cursor_col: str, shard_id: int | None = None) -> DataFrame:
    """One row holding the newest cursor already loaded (1970 for an empty target)."""
    if shard_id is not None:
        target = target.filter(F.col("shard_id") == shard_id)
    return target.agg(
        F.coalesce(F.max(cursor_col), F.lit(EPOCH).cast("timestamp")).alias("high_water_mark")
    )


def extract_incremental(
    src: DataFrame, target: DataFrame, cursor_col: str, shard_id: int
) -> DataFrame:
    """Rows of one source shard past the target's high-water mark.

    The mark is a scalar subquery: its value is known before the source is read, so it reaches the
    scan as a filter and old row groups are skipped.
    """
    mark = high_water_mark(target, cursor_col, shard_id).scalar()
    return src.filter(F.col(cursor_col) > mark).withColumn("shard_id", F.lit(shard_id))


def read_jdbc_shard(
    spark, url: str, table: str, column: str, lower: str, upper: str, parts: int, properties: dict
) -> DataFrame:
    """Parallel range read of one relational shard."""
    return spark.read.jdbc(
        url, table, column=column, lowerBound=lower, upperBound=upper, numPartitions=parts,
        properties=properties,
    )


def union_shards(shards: dict[int, DataFrame]) -> DataFrame:
    """UNION ALL of the shards, each row tagged with its shard."""
    tagged = [df.withColumn("shard_id", F.lit(shard)) for shard, df in sorted(shards.items())]
    return reduce(DataFrame.unionByName, tagged)


def with_shard(df: DataFrame, column: str, shards: int) -> DataFrame:
    return df.withColumn("shard_id", shard_of(F.col(column), shards))


def load_raw(df: DataFrame, source_system: str, as_of: str) -> DataFrame:
    """Lineage columns of the RAW layer; load_date is the daily partition."""
    loaded_at = F.lit(as_of).cast("timestamp")
    return (
        df.withColumn("loaded_at", loaded_at)
        .withColumn("source_system", F.lit(source_system))
        .withColumn("load_date", F.to_date("loaded_at"))
    )


def extract_rentals(rentals: DataFrame, cost_snapshots: DataFrame) -> DataFrame:
    """Rentals with their final cost, taken from the latest cost snapshot.

    The snapshots are reduced to one row per rental before they meet the rentals, so a rental with
    very many snapshots costs one row in the join.
    """
    final = latest_per_key(
        cost_snapshots.select("rental_id", "ts", "id", "cost_amount"), ["rental_id"], ["ts", "id"]
    ).select("rental_id", F.col("cost_amount").alias("final_cost"))
    return rentals.join(final, "rental_id", "left")


def extract_events(df: DataFrame) -> DataFrame:
    """Event log with the warehouse's column name for the type, and its daily partition."""
    if "type" in df.columns:
        df = df.withColumnRenamed("type", "event_type")
    return df.withColumn("event_date", F.to_date("ts"))


def shard_balance(
    df: DataFrame, shards: int, row_bytes: int, limit_bytes: int, column: str = "user_id"
) -> DataFrame:
    """Rows, estimated size and share of each shard, and whether it passes the size limit."""
    sizes = with_shard(df.select(column), column, shards).groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    total = F.sum("row_count").over(Window.partitionBy())  # one row per shard here
    estimate = F.col("row_count") * F.lit(row_bytes).cast("bigint")
    return sizes.withColumn("total", total).select(
        "shard_id",
        "row_count",
        estimate.alias("estimated_bytes"),
        F.round(F.col("row_count") / F.col("total"), 4).alias("share"),
        (estimate > F.lit(limit_bytes).cast("bigint")).alias("over_limit"),
    )
