"""Data-quality checks. Each returns rows (check_name, table_name, key, observed, expected, passed);
checks that list offenders return one row per offender and none when all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from voltmart.functions.scalar import NULL_KEY_PART

RESULT = ["check_name", "table_name", "key", "observed", "expected", "passed"]


def _text(column) -> Column:
    return column.cast("string")


def _key(keys: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit(NULL_KEY_PART)) for k in keys])


def _result(df: DataFrame, check: str, table: str, key, observed, expected, passed) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"),
        _text(key).alias("key"), _text(observed).alias("observed"),
        _text(expected).alias("expected"), passed.alias("passed"),
    )


def check_complete(src: DataFrame, raw: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Source keys that never reached RAW."""
    missing = src.select(*keys).distinct().join(raw.select(*keys), keys, "left_anti")
    return _result(missing, "complete", table, _key(keys), F.lit("missing"), F.lit("present"),
                   F.lit(False))


def check_timely(
    raw: DataFrame, ts_col: str, keys: list[str], table: str, minutes: int = 15
) -> DataFrame:
    """Rows loaded later than `minutes` after their source time."""
    late = F.unix_seconds("loaded_at") - F.unix_seconds(ts_col)
    return _result(raw.filter(late > minutes * 60), "timely", table, _key(keys), late,
                   F.lit(minutes * 60), F.lit(False))


def check_schema(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """Declared against actual column types; reads metadata only."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = [
        ("schema", table, f.name, actual.get(f.name, "absent"), f.dataType.simpleString(),
         actual.get(f.name) == f.dataType.simpleString())
        for f in schema.fields
    ]
    return df.sparkSession.createDataFrame(
        rows, "check_name string, table_name string, key string, observed string, "
        "expected string, passed boolean"
    )


def check_fk(fact: DataFrame, dim: DataFrame, key: str, table: str, dim_key: str | None = None) -> DataFrame:
    """Foreign keys without a dimension row, with the number of facts using each.

    Facts are counted per key first, so a hot key is one row in the anti join.
    """
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    known = dim.select(F.col(dim_key or key).alias(key))
    return _result(used.join(known, key, "left_anti"), f"fk_{key}", table, F.col(key),
                   F.col("_n"), F.lit(0), F.lit(False))


def check_rules(fact: DataFrame, table: str = "fact_rentals") -> DataFrame:
    """Violations of the three business rules, counted in one pass."""
    rules = {
        "duration_not_negative": F.col("duration_minutes") < 0,
        "cost_not_negative": F.col("final_cost") < 0,
        "finished_after_started": F.col("is_completed")
        & (F.col("finished_at").isNull() | (F.col("finished_at") <= F.col("started_at"))),
    }
    counts = fact.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    pairs = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(n).alias("n")) for n in rules])
    listed = counts.select(F.explode(pairs).alias("r")).select("r.*")
    return _result(listed, "rules", table, F.col("rule"), F.col("n"), F.lit(0), F.col("n") == 0)


def check_unique(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Keys occurring more than once."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return _result(repeated, "unique", table, _key(keys), F.col("_n"), F.lit(1), F.lit(False))


def check_totals(mart: DataFrame, fact: DataFrame, measures: dict[str, Column], table: str) -> DataFrame:
    """Sums of mart columns against the facts; `measures` maps a mart column to a fact aggregate."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("decimal(38,2)")
    left = mart.agg(*[zero(F.sum(m)).alias(f"m_{m}") for m in measures])
    right = fact.agg(*[zero(a).alias(f"f_{m}") for m, a in measures.items()])
    pairs = F.array(*[
        F.struct(F.lit(m).alias("measure"), F.col(f"m_{m}").alias("mart"), F.col(f"f_{m}").alias("fact"))
        for m in measures
    ])
    both = left.crossJoin(F.broadcast(right)).select(F.explode(pairs).alias("p")).select("p.*")
    return _result(both, "totals", table, F.col("measure"), F.col("mart"), F.col("fact"),
                   F.col("mart") == F.col("fact"))


def check_empty(df: DataFrame, check: str, table: str) -> DataFrame:
    """Rows of a table that should have none."""
    counted = df.agg(F.count(F.lit(1)).alias("_n"))
    return _result(counted, check, table, F.lit("rows"), F.col("_n"), F.lit(0), F.col("_n") == 0)


def check_dates(mart: DataFrame, spine: DataFrame, table: str) -> DataFrame:
    """Days of the period a mart does not have."""
    missing = spine.select("date_actual").join(mart.select("date_actual"), "date_actual", "left_anti")
    return _result(missing, "dates", table, F.col("date_actual"), F.lit("missing"),
                   F.lit("present"), F.lit(False))


def row_counts(tables: dict[str, DataFrame], date_col: str = "load_date") -> DataFrame:
    """Rows added to each table per load day."""
    counted = [
        df.groupBy(F.col(date_col).alias("load_date"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted).select("table_name", "load_date", "row_count")


def check_growth(counts: DataFrame, percent: int = 50) -> DataFrame:
    """Days on which a table grew by more than `percent` of its size the day before.

    The input has one row per table and day, so both windows are bounded by the calendar.
    """
    days = Window.partitionBy("table_name").orderBy("load_date")
    sized = counts.withColumn("_size", F.sum("row_count").over(days)).withColumn(
        "_before", F.lag("_size").over(days)
    )
    grown = sized.filter(
        F.col("_before").isNotNull()
        & (F.col("row_count") * 100 > F.col("_before") * percent)
    )
    return grown.select(
        F.lit("growth").alias("check_name"), "table_name", _text(F.col("load_date")).alias("key"),
        _text(F.col("row_count")).alias("observed"), _text(F.col("_before")).alias("expected"),
        F.lit(False).alias("passed"),
    )


def check_fresh(raw: DataFrame, as_of: str, table: str, hours: int = 1) -> DataFrame:
    """Age of the newest load against the limit."""
    age = F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("_newest")
    newest = raw.agg(F.max("loaded_at").alias("_newest"))
    return _result(newest, "fresh", table, F.lit("loaded_at"), age, F.lit(hours * 3600),
                   F.coalesce(age <= hours * 3600, F.lit(False)))


def check_revenue_drop(alerts: DataFrame) -> DataFrame:
    """Days whose revenue fell below the alert line; input is dashboard.revenue_alert."""
    return _result(alerts.filter("alert"), "revenue_drop", "dm_daily_metrics",
                   F.col("date_actual"), F.col("total_revenue"), F.col("trailing_mean"),
                   F.lit(False))


def all_checks(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)
