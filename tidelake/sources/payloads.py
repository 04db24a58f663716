"""Reference data: payloads of public interfaces and seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOLIDAYS = "holiday_date date, holiday_name string, country_code string"
WEATHER = "city string, weather_date date, precipitation_mm double, temp_max_c double, temp_min_c double"

_DAILY = "daily struct<time: array<string>, precipitation_sum: array<double>, temperature_2m_max: array<double>, temperature_2m_min: array<double>>"
_HOLIDAY_LIST = "array<struct<date: string, localName: string, name: string, countryCode: string>>"

#: Public holidays of India in 2026 (fixed values): date, name, country.
HOLIDAY_SEED = (
    ("2026-01-26", "Republic Day", "IN"),
    ("2026-03-04", "Holi", "IN"),
    ("2026-03-21", "Id-ul-Fitr", "IN"),
    ("2026-04-01", "Mahavir Jayanti", "IN"),
    ("2026-04-03", "Good Friday", "IN"),
    ("2026-05-01", "Buddha Purnima", "IN"),
    ("2026-05-27", "Id-ul-Zuha (Bakrid)", "IN"),
    ("2026-06-26", "Muharram", "IN"),
    ("2026-08-15", "Independence Day", "IN"),
    ("2026-08-26", "Janmashtami", "IN"),
    ("2026-09-04", "Milad-un-Nabi", "IN"),
    ("2026-10-02", "Gandhi Jayanti", "IN"),
    ("2026-10-20", "Dussehra", "IN"),
    ("2026-11-08", "Diwali", "IN"),
    ("2026-11-24", "Guru Nanak Jayanti", "IN"),
    ("2026-12-25", "Christmas Day", "IN"),
)


def holiday_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The seed, or a CSV file with a header in its shape, with dates as dates."""
    if path:
        return spark.read.schema(HOLIDAYS).option("header", True).csv(path)
    rows = spark.createDataFrame(list(HOLIDAY_SEED), "d string, holiday_name string, country_code string")
    return rows.select(F.to_date("d").alias("holiday_date"), "holiday_name", "country_code")


def parse_weather_payload(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each city and day from (city, payload): parallel arrays by the place of the
    day.  A series that is missing or too short gives null, and so does a null in it."""
    daily = payloads.select("city", F.from_json(payload, _DAILY).getField("daily").alias("d"))
    days = daily.select("city", "d", F.posexplode("d.time").alias("i", "day"))
    series = {"precipitation_mm": "precipitation_sum", "temp_max_c": "temperature_2m_max", "temp_min_c": "temperature_2m_min"}
    return days.select("city", F.expr("try_cast(day AS date)").alias("weather_date"), *[F.get(F.col(f"d.{s}"), F.col("i")).alias(n) for n, s in series.items()])


def parse_holiday_payload(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """One row for each holiday in lists of them; the local name goes first unless it is empty."""
    each = payloads.select(F.explode(F.from_json(payload, _HOLIDAY_LIST)).alias("h"))
    name = F.coalesce(F.nullif(F.col("h.localName"), F.lit("")), F.col("h.name"))
    return each.select(F.expr("try_cast(h.date AS date)").alias("holiday_date"), name.alias("holiday_name"), F.col("h.countryCode").alias("country_code"))
