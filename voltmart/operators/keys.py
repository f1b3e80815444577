"""Key-based building blocks: latest row, de-duplication, insert-if-absent, upsert, intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from voltmart.schemas import OPEN_END


def latest_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Newest row of every key.

    `row_number() = 1` lets Spark drop all but one candidate per key before the shuffle, so a key
    holding a third of the rows sends one row per input task instead of all its copies.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc_nulls_last(c) for c in order_cols])
    return df.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def dedup_latest(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Latest load wins; ties fall to the remaining columns, so that any run picks the same row."""
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    return latest_per_key(df, keys, [*order_cols, *rest])


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the new rows whose key it does not hold yet (one per key)."""
    fresh = dedup_latest(new, keys, []).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def upsert(
    target: DataFrame, src: DataFrame, keys: list[str], update_cols: list[str],
    order_cols: list[str] | None = None, cells: tuple[Column, int] | None = None,
    before: list[str] | None = None,
) -> DataFrame:
    """Update the listed columns where the key exists, insert the whole row where it does not.

    An update takes the source value even when it is NULL. With `order_cols` a source row older than
    the stored one changes nothing (NULL is oldest, on a tie the source wins), and these columns
    follow the row that won. Keys are unique on both sides, so the full outer join has no hot key.

    With `cells`, a column that is never NULL and equal for rows of equal keys, and a number of tasks, rows meet by
    cell and stay together by cell: a result that is written by cells needs no further shuffle.

    With `before`, columns of the target, rows also carry `_came`, whether the source has their key, and
    `_before`, these columns as they were stored, NULL for a new key.
    """
    old, new = target.withColumn("_old", F.lit(True)), src.withColumn("_new", F.lit(True))
    if cells:
        cell, tasks = cells
        old, new = [df.withColumn("_cell", cell).repartition(tasks, "_cell") for df in (old, new)]
    old, new = old.alias("t"), new.alias("s")
    on = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    if cells:
        on = [F.col("t._cell") == F.col("s._cell"), *on]
    joined = old.join(new, on, "full_outer")
    in_target, in_source = F.col("t._old").isNotNull(), F.col("s._new").isNotNull()
    wins = in_source
    if order_cols:
        at = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order_cols])
        wins = in_source & (~in_target | (at("s") >= at("t")))
        update_cols = [*update_cols, *order_cols]

    def pick(name: str) -> Column:
        if name not in src.columns:
            return F.col(f"t.{name}")
        if name in keys:
            return F.coalesce(f"t.{name}", f"s.{name}").alias(name)
        if name in update_cols:
            source_wins = wins
        else:
            source_wins = ~in_target
        return F.when(source_wins, F.col(f"s.{name}")).otherwise(F.col(f"t.{name}")).alias(name)

    carried = []
    if before is not None:
        stored = F.struct(*[F.col(f"t.{c}").alias(c) for c in before])
        carried = [in_source.alias("_came"), F.when(in_source & in_target, stored).alias("_before")]
    return joined.select(*[pick(c) for c in target.columns], *carried)


def close_intervals(
    df: DataFrame, keys: list[str], tie: list[str], start: str = "valid_from"
) -> DataFrame:
    """valid_to from the next version of the same key, open end for the last one.

    For versions already reduced to few rows per key. Versions starting together follow each other
    in the order of `tie`, all but the last with an empty interval.
    """
    following = Window.partitionBy(*keys).orderBy(start, *tie)
    return df.withColumn(
        "valid_to",
        F.coalesce(F.lead(start).over(following), F.lit(OPEN_END).cast("timestamp")),
    )
