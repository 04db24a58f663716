"""Dates, holidays and weather."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelake.functions.keys import surrogate_key

RAIN_MM, HEAVY_RAIN_MM = 1.0, 10.0


def date_bounds(rows: DataFrame, column: str, margin_days: int = 0) -> DataFrame:
    """One row (lo, hi): first and last day of a timestamp column, widened on both sides."""
    day = F.to_date(column)
    return rows.agg(F.min(day).alias("lo"), F.max(day).alias("hi")).select(F.date_sub("lo", margin_days).alias("lo"), F.date_add("hi", margin_days).alias("hi"))


def holidays_dedup(*sources: DataFrame) -> DataFrame:
    """One name for each holiday date out of several lists."""
    every = sources[0].select("holiday_date", "holiday_name")
    for s in sources[1:]:
        every = every.unionAll(s.select("holiday_date", "holiday_name"))
    return every.groupBy("holiday_date").agg(F.max("holiday_name").alias("holiday_name"))


def dim_date(bounds: DataFrame, holidays: DataFrame) -> DataFrame:
    """One row for each day from lo to hi; holidays go before weekends."""
    days = bounds.select(F.explode(F.expr("sequence(lo, hi, interval 1 day)")).alias("date_day"))
    named = days.join(holidays, F.col("date_day") == F.col("holiday_date"), "left")
    d = F.col("date_day")
    weekend, holiday = F.dayofweek(d).isin(1, 7), F.col("holiday_date").isNotNull()
    return named.select(
        surrogate_key(["date_day"]).alias("date_sk"), d,
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"), F.weekofyear(d).alias("week_of_year"), F.dayofweek(d).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_name"),
        weekend.alias("is_weekend"), holiday.alias("is_holiday"), "holiday_name",
        F.when(holiday, "HOLIDAY").when(weekend, "WEEKEND").otherwise("WEEKDAY").alias("day_type"),
    )


def dim_weather(weather: DataFrame) -> DataFrame:
    """One row for each city and day; unknown rain is not rain but has a band of its own."""
    mm = F.col("precipitation_mm")
    band = F.when(mm.isNull(), "UNKNOWN").when(mm >= HEAVY_RAIN_MM, "HEAVY_RAIN").when(mm >= RAIN_MM, "RAIN").otherwise("CLEAR")
    return weather.select(
        surrogate_key(["city", "weather_date"]).alias("weather_sk"), "city", "weather_date", "precipitation_mm", "temp_max_c", "temp_min_c",
        (F.coalesce(mm, F.lit(0.0)) >= RAIN_MM).alias("is_rainy"), band.alias("weather_band"),
    )


def city_centroids(restaurants: DataFrame) -> DataFrame:
    """Mean place of the current restaurants of each city, by name."""
    current = restaurants.where("is_current and not is_deleted")
    return current.groupBy("city").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon")).orderBy("city")
