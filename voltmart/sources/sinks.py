"""Writing layers: partitioned appends, versioned marts, partition upserts, retention."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.utils import AnalysisException

from voltmart.operators.keys import upsert
from voltmart.session import cut_lineage, remove, work_dir


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, None when nothing was written there yet. Other errors are raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        # A partitioned table that was written without rows has a folder and no file yet.
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def append_raw(df: DataFrame, path: str) -> None:
    """Daily RAW partitions. A load is of one day, so each task writes one file of it as it is: nothing is
    shuffled to bring a day together."""
    df.write.partitionBy("load_date").mode("append").parquet(path)


def _in_months(df: DataFrame, part_col: str, sort_col: str | None, placed: bool = False) -> DataFrame:
    """Rebalance lets AQE split a hot month over many files and merge thin ones; the local sort
    keeps min/max statistics narrow for look-ups by sort_col. Rows `placed` by month already are only sorted."""
    df = df if placed else df.hint("rebalance", part_col)
    return df.sortWithinPartitions(part_col, *([sort_col] if sort_col else []))


def write_fact(df: DataFrame, path: str, sort_col: str = "station_dwh_id") -> None:
    """All monthly fact partitions at once."""
    _in_months(df, "month_id", sort_col).write.partitionBy("month_id").mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Catalogue table bucketed and sorted by a key: joins and groupings of two such tables on it
    need no shuffle. For facts that keep meeting on the user."""
    df.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").saveAsTable(table)


MAX_PARTITIONS = 10_000  # partition values one upsert may touch: they pass through the driver


def _partitions(df: DataFrame, part_col: str) -> set:
    found = {row[0] for row in df.select(part_col).distinct().limit(MAX_PARTITIONS + 1).collect()}
    if len(found) > MAX_PARTITIONS:
        raise ValueError(f"{part_col} has more than {MAX_PARTITIONS} values in one upsert")
    return found


SMALL_SOURCE = 100_000  # source rows up to which an upsert leaves it to Spark whether their keys are broadcast
CELL_ROWS = 500_000  # rows of a partition that one task of a merge takes; it writes a file of them


def _sizes(df: DataFrame, part_col: str) -> dict:
    """Rows by partition value; values beyond MAX_PARTITIONS are refused."""
    counted = df.groupBy(part_col).agg(F.count(F.lit(1)).alias("_rows")).limit(MAX_PARTITIONS + 1).collect()
    if len(counted) > MAX_PARTITIONS:
        raise ValueError(f"{part_col} has more than {MAX_PARTITIONS} values in one upsert")
    return {row[0]: row[1] for row in counted}


def _cells(spark: SparkSession, keys: list[str], part_col: str, sizes: list[dict]) -> tuple[Column, int]:
    """Cells of partitions (see keys.upsert): a partition, or slots of one by hash of the key if it is large."""
    rows = {value: sum(size.get(value, 0) for size in sizes) for value in {v for size in sizes for v in size}}
    slots = -(-max(rows.values(), default=1) // CELL_ROWS)
    # With fewer tasks than a shuffle has by default the join would shuffle again.
    tasks = max(-(-sum(rows.values()) // CELL_ROWS) * 2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    slot = F.pmod(F.xxhash64(*keys), F.lit(slots))
    return F.xxhash64(F.col(part_col), slot), tasks


def signed_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """What turns `old` into `new`, both unique by their keys and of equal columns: rows that are gone or
    were different with _sign -1, rows that are there now with _sign +1. Equal rows do not show."""
    columns = new.columns
    row = lambda df, name: df.select(
        *[F.col(k).alias(f"_{name}_{k}") for k in keys], F.struct(*columns).alias(name)
    )
    same = [F.col(f"_before_{k}").eqNullSafe(F.col(f"_after_{k}")) for k in keys]
    both = row(old, "before").join(row(new, "after"), same, "full_outer")
    signed = lambda name, sign: F.when(
        F.col(name).isNotNull(), F.struct(*[F.col(f"{name}.{c}").alias(c) for c in columns], F.lit(sign).alias("_sign"))
    )
    sides = F.array_compact(F.array(signed("before", -1), signed("after", 1)))
    return both.filter(~F.col("before").eqNullSafe(F.col("after"))).select(F.inline(sides))


def _staged_changes(merged: DataFrame, columns: list[str]) -> DataFrame:
    """The same from merged rows that carry what was stored before (see keys.upsert)."""
    row = F.struct(*columns)
    signed = lambda source, sign: F.struct(*[source(c).alias(c) for c in columns], F.lit(sign).alias("_sign"))
    sides = F.array_compact(F.array(
        F.when(F.col("_before").isNotNull(), signed(lambda c: F.col(f"_before.{c}"), -1)), signed(F.col, 1)
    ))
    return merged.filter(F.col("_came") & ~F.col("_before").eqNullSafe(row)).select(F.inline(sides))


def _log_changes(changes: DataFrame, log: tuple[str, str]) -> None:
    """Publish the signed changes of a run once: a run that is repeated after its swap would see none."""
    name, path = log
    if read_version(changes.sparkSession, name, path) is None:
        refresh_mart(name, changes, path)


def upsert_partitions(
    spark: SparkSession, path: str, src: DataFrame, keys: list[str], update_cols: list[str],
    part_col: str = "month_id", sort_col: str | None = None, order_cols: list[str] | None = None,
    log: tuple[str, str] | None = None, log_columns: list[str] | None = None, written: bool = False,
    held_col: str | None = None, staged: bool = True,
) -> DataFrame:
    """Upsert into partitioned parquet, rewriting only the partitions the source touches.

    Touched are the partitions of the source rows and those that hold their keys now, which a
    projection of keys and partition finds; a key therefore stays unique when it moves. NULL is a
    partition like any other. part_col follows the source where it is among `update_cols`. With
    `order_cols` older source rows lose (see keys.upsert).

    The merged partitions are staged in the shared folder and only then swapped in with dynamic
    overwrite, so an input is never overwritten while it is read and a failed swap can be repeated.
    Where no key moves, old and new rows meet by partition and hash of the key, so that the join leaves rows where
    they are written; where one does, they meet by key and are brought to their partitions afterwards.
    Without `staged` the former are written once: dynamic overwrite itself lays all new files aside before it touches
    a partition, so the old ones are read to the end.
    Returns the source rows as materialised on the way; a source that is already a `written` table is not
    written again.

    With `log`, a run's name and a folder, the signed changes of `log_columns` (default: all) are published
    there before the swap; the same run finds them there when it is repeated (see changes_of). They are read from the
    stage, whose rows then carry what was stored before.

    A source that has looked its keys up names in `held_col` a struct of the partition that holds the key, NULL for a
    new key, in place of the projection. The column is not stored.
    """
    swap = lambda df, placed=False: _in_months(df, part_col, sort_col, placed).write.partitionBy(
        part_col
    ).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    target = read_if_present(spark, path)
    src = src if written else cut_lineage(src, "increment")
    found, src = src, src.drop(held_col) if held_col else src
    if target is None:
        if log:
            _log_changes(src.select(*(log_columns or src.columns), F.lit(1).alias("_sign")), log)
        swap(src)
        return src
    target = target.withColumn(part_col, F.col(part_col).cast(src.schema[part_col].dataType))
    arriving = _sizes(src, part_col)
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]
    if held_col:
        at = F.col(f"{held_col}.{part_col}")
        held = found.filter(F.col(held_col).isNotNull()).select(
            at.alias(part_col), at.eqNullSafe(F.col(part_col)).alias("_stays")
        )
    else:
        now = target.select(*keys, part_col).alias("t")
        placing = src.select(*keys, part_col)
        if sum(arriving.values()) > SMALL_SOURCE:  # compressed files look smaller than the keys that the driver would hold
            placing = placing.hint("merge")
        held = now.join(placing.alias("s"), same).select(
            F.col(f"t.{part_col}").alias(part_col),
            F.col(f"t.{part_col}").eqNullSafe(F.col(f"s.{part_col}")).alias("_stays"),
        )
    stored = held.groupBy(part_col).agg(F.min("_stays").alias("_stay"), F.count(F.lit(1)).alias("_met")).limit(
        MAX_PARTITIONS + 1
    ).collect()
    if len(stored) > MAX_PARTITIONS:
        raise ValueError(f"{part_col} has more than {MAX_PARTITIONS} values in one upsert")
    touched = arriving.keys() | {row[0] for row in stored}
    wanted = F.col(part_col).isin([value for value in touched if value is not None])
    if None in touched:
        wanted = F.coalesce(wanted, F.lit(False)) | F.col(part_col).isNull()
    old = target.filter(wanted)
    placed, sizes = all(row["_stay"] for row in stored), _sizes(old, part_col)
    cells = _cells(spark, keys, part_col, [arriving, sizes]) if placed else None
    columns = log_columns or target.columns
    merged = upsert(old, src, keys, update_cols, order_cols, cells, columns if log else None)
    if placed and not log and not staged:
        swap(merged, placed)
        return src
    stage, schema = work_dir(spark, "stage"), merged.schema
    if placed:
        _in_months(merged, part_col, sort_col, placed).write.partitionBy(part_col).parquet(stage)
    else:
        merged.write.parquet(stage)
    carrying = spark.read.schema(schema).parquet(stage)
    merged = carrying.select(*target.columns)
    if log:
        unique = sum(sizes.values()) + sum(arriving.values()) - sum(row["_met"] for row in stored)
        if carrying.count() == unique:
            changes = _staged_changes(carrying, columns)
        else:  # a key that repeats: every old row against every new one
            asked = src.select(*keys).alias("s")
            of_source = lambda df: df.alias("t").join(asked, same, "left_semi").select(*columns)
            changes = signed_changes(of_source(old), of_source(merged), keys)
        _log_changes(changes, log)
    swap(merged, placed)
    # Dynamic overwrite leaves a partition alone whose last row has moved away: empty it by itself.
    for value in touched - _partitions(merged, part_col):
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        merged.drop(part_col).limit(0).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(f"{path}/{part_col}={name}")
    remove(spark, stage)
    return src


def changes_of(spark: SparkSession, log: tuple[str, str]) -> DataFrame | None:
    """The signed changes that a run published."""
    return read_version(spark, *log)


def refresh_mart(name: str, df: DataFrame, path: str, published: str | None = None) -> str:
    """Write a full new version of a mart, then publish it by appending one pointer row.

    `published` is the time that its retention counts from (default: now). Readers keep the version they resolved. A version left half-written by a failed run is never
    pointed at and, its folder being unique, not in the way of the next run either.
    """
    spark = df.sparkSession
    version = _next_version(spark, name, path)
    target = f"{path}/{name}/v{version:08d}-{uuid.uuid4().hex[:8]}"
    df.write.mode("errorifexists").parquet(target)
    pointer = spark.range(1).select(
        F.lit(name).alias("mart"),
        F.lit(version).cast("bigint").alias("version"),
        F.lit(target).alias("location"),
        F.lit(published).cast("timestamp").alias("published_at") if published else F.current_timestamp().alias("published_at"),
    )
    pointer.coalesce(1).write.mode("append").parquet(f"{path}/{name}/pointers")
    return target


def _latest(spark: SparkSession, name: str, path: str):
    pointers = read_if_present(spark, f"{path}/{name}/pointers")
    return None if pointers is None else pointers.orderBy(F.desc("version")).first()


def _next_version(spark: SparkSession, name: str, path: str) -> int:
    last = _latest(spark, name, path)
    return 1 if last is None else last["version"] + 1


def read_version(spark: SparkSession, name: str, path: str) -> DataFrame | None:
    """The version published last, None before the first."""
    last = _latest(spark, name, path)
    return None if last is None else spark.read.parquet(last["location"])


def read_mart(spark: SparkSession, name: str, path: str) -> DataFrame:
    mart = read_version(spark, name, path)
    if mart is None:
        raise LookupError(f"mart {name} was never published under {path}")
    return mart


def apply_retention(
    df: DataFrame, ts_col: str, days: int, as_of: str
) -> tuple[DataFrame, DataFrame]:
    """(keep, archive): two disjoint filters on the same scan, meant for two writes.

    A row without a timestamp has no age and is kept.
    """
    cutoff = F.date_sub(F.to_date(F.lit(as_of)), days).cast("timestamp")
    old = F.coalesce(F.col(ts_col) < cutoff, F.lit(False))
    return df.filter(~old), df.filter(old)


def _partition_day(part_col: str, kind: str) -> Column:
    """The last day of a partition: its date, its day (YYYYMMDD) or the end of its month (YYYYMM)."""
    if kind == "date":
        return F.col(part_col)
    if part_col == "month_id":
        return F.last_day(F.to_date(F.concat(F.col(part_col).cast("string"), F.lit("01")), "yyyyMMdd"))
    return F.to_date(F.col(part_col).cast("string"), "yyyyMMdd")


def archive_partitions(
    spark: SparkSession, df: DataFrame, path: str, archive: str, part_col: str, days: int, as_of: str
) -> None:
    """Copy the partitions past their retention to the archive, then empty them. A partition is past it
    when its last day is; one without a day is kept.

    Both steps work on whole partitions and can be repeated: the copy overwrites its own partitions only, and
    one is emptied after its copy is there.
    """
    kind = df.schema[part_col].dataType.simpleString()
    parts = df.select(part_col).distinct().withColumn("_day", _partition_day(part_col, kind))
    _, old = apply_retention(parts, "_day", days, as_of)
    gone = _partitions(old, part_col)
    if not gone:
        return
    full = df.filter(F.col(part_col).isin(list(gone)))
    full.write.partitionBy(part_col).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(archive)
    for value in gone:
        spark.createDataFrame([], df.drop(part_col).schema).write.mode("overwrite").option(
            "partitionOverwriteMode", "static"
        ).parquet(f"{path}/{part_col}={value}")


def archive_versions(
    spark: SparkSession, name: str, path: str, archive: str, days: int, as_of: str
) -> None:
    """Copy versions that were replaced longer ago than the retention to the archive and empty their folders. The
    version published last stays, whatever its age. Versions published before pointers had a time stay too."""
    pointers = read_if_present(spark, f"{path}/{name}/pointers")
    if pointers is None or "published_at" not in pointers.columns:
        return
    newest_first = Window.orderBy("version")
    replaced = pointers.withColumn("_replaced_at", F.lead("published_at").over(newest_first))
    _, old = apply_retention(replaced.filter(F.col("_replaced_at").isNotNull()), "_replaced_at", days, as_of)
    for row in old.collect():  # a version per run, one row each
        version = read_if_present(spark, row["location"])
        if version is None or version.isEmpty():
            continue
        version.write.mode("overwrite").parquet(f"{archive}/{name}/v{row['version']:08d}")
        spark.createDataFrame([], version.schema).write.mode("overwrite").parquet(row["location"])
