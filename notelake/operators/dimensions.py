"""Dimensions: generated calendars, small lookups and slowly changing users."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions import places


def days(first: str, last: str, spark: SparkSession) -> DataFrame:
    """One row per date from first to last."""
    d = F.col("date")
    base = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))).alias("date"))
    return base.select(
        "date",
        F.extract(F.lit("YEAROFWEEK"), d).alias("iso_year"),
        F.weekofyear(d).alias("iso_week"),
        F.dayofyear(d).alias("day_of_year"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "MMM").alias("month_name"),
        F.date_format(d, "EEE").alias("day_name"),
        F.extract(F.lit("DAYOFWEEK_ISO"), d).isin(6, 7).alias("is_weekend"),
        (F.last_day(d) == d).alias("is_month_end"),
        ((F.last_day(d) == d) & (F.month(d) % 3 == 0)).alias("is_quarter_end"),
        ((F.month(d) == 12) & (F.dayofmonth(d) == 31)).alias("is_year_end"),
    )


def regions(spark: SparkSession) -> DataFrame:
    """region, continent: the fixed table."""
    return spark.createDataFrame(places.REGIONS, "region string, continent string")


def located(countries: DataFrame, spark: SparkSession, name: str = "country_name_en") -> DataFrame:
    """Countries with alpha2, alpha3 and region by their English name, whatever its case; unknown ones: null codes, region Undefined."""
    known = spark.createDataFrame(places.COUNTRIES, "_name string, alpha2 string, alpha3 string, region string").withColumn("_name", F.lower("_name"))
    met = countries.join(F.broadcast(known), F.lower(name) == F.col("_name"), "left").drop("_name")
    return met.withColumn("region", F.coalesce("region", F.lit(places.REGIONS[0][0])))


def time_of_week(spark: SparkSession) -> DataFrame:
    """The 168 hours of a week."""
    day, hour = F.floor(F.col("id") / 24).cast("int"), (F.col("id") % 24).cast("int")
    return spark.range(168).select(((day + 1) * 100 + hour).alias("how"), F.col("id").cast("int").alias("hour_of_week"), C.period_of_day(hour).alias("period"))


def users_changed(old: DataFrame, fresh: DataFrame, at: str) -> DataFrame:
    """Slowly changing users: (user_id, username, valid_from, valid_to, is_current).

    New users become current rows; a changed name, nulls told apart, closes the current row at `at` and opens another.
    """
    now = F.lit(at).cast("timestamp_ntz")
    j = old.where("is_current").join(fresh.select("user_id", F.col("username").alias("_name"), F.lit(True).alias("_there")), "user_id", "left")
    renamed = F.coalesce(F.col("_there"), F.lit(False)) & ~F.col("username").eqNullSafe(F.col("_name"))
    kept = j.select("user_id", "username", "valid_from", F.when(renamed, now).otherwise(F.col("valid_to")).alias("valid_to"), (~renamed).alias("is_current"))
    row = [now.alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current")]
    opened = j.where(renamed).select("user_id", F.col("_name").alias("username"), *row)
    new = fresh.join(old.select("user_id").distinct(), "user_id", "left_anti").select("user_id", "username", *row)
    return old.where("NOT is_current").unionByName(kept).unionByName(opened).unionByName(new)


def countries_upserted(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """New and renamed countries are marked as modified; an ISO code stays where the new one is null."""
    o, n = old.alias("o"), fresh.alias("n")
    j = o.join(n, F.col("o.country_id") == F.col("n.country_id"), "full")
    changed = F.col("n.country_id").isNotNull() & (F.col("o.country_id").isNull() | ~F.col("o.country_name").eqNullSafe(F.col("n.country_name")))
    pick = lambda c: F.when(F.col("n.country_id").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}"))
    return j.select(F.coalesce("n.country_id", "o.country_id").alias("country_id"), pick("country_name").alias("country_name"), F.coalesce("n.iso", "o.iso").alias("iso"), changed.alias("modified"))
