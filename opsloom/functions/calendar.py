"""Calendar columns and timestamp parsing, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: extended ISO-8601 date, then optionally one separator, a time, a fraction and an offset.
ISO_TIMESTAMP = (
    r"^\d{4}-\d{2}-\d{2}(.\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
# Fixed value: the usual spelling, which Spark's own cast reads as it stands.
PLAIN_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?$"


def parse_iso(text: Column) -> Column:
    """Timestamp of an ISO-8601 text, NULL when it is not one. Texts without offset are UTC.

    The usual spelling takes one match and a cast; the rarer ones are first brought to it. The zero
    offset is cut off before the cast, which reads any offset several times slower than none.
    """
    spelled = F.translate(text, ",", ".")
    spelled = F.regexp_replace(spelled, r"^(.{10}).(\d{2})", "$1T$2")  # any separator
    spelled = F.regexp_replace(spelled, r"(\.\d{6})\d+", "$1")  # digits past the microsecond
    parsed = F.try_to_timestamp(spelled, F.lit("yyyy-MM-dd['T'HH[:mm[:ss[.SSSSSS]]][XXX][XX]]"))
    plain = F.substring_index(text, "+00:00", 1).try_cast("timestamp")
    return F.when(text.rlike(PLAIN_TIMESTAMP), plain).when(
        text.rlike(ISO_TIMESTAMP), parsed
    )


def with_calendar(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Partition keys as zero-padded text plus hour, weekday name and weekend flag."""
    t = F.col(ts)
    return df.withColumns(
        {
            "year": F.date_format(t, "yyyy"),
            "month": F.date_format(t, "MM"),
            "day": F.date_format(t, "dd"),
            "hour": F.hour(t),
            "day_of_week": F.date_format(t, "EEEE"),
            "is_weekend": F.weekday(t) >= 5,
        }
    )


def date_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def on_days(df: DataFrame, first: Column, last: Column) -> DataFrame:
    """Where the rows carry the lake's partition keys, keep the days from `first` to `last` only.

    The condition reads nothing but partition keys, so folders of other days are never opened.
    """
    if not {"year", "month", "day"} <= set(df.columns):
        return df
    key = F.concat("year", "month", "day")
    return df.where(key.between(F.date_format(first, "yyyyMMdd"), F.date_format(last, "yyyyMMdd")))


def build_dim_date(bounds: DataFrame) -> DataFrame:
    """One row per day between `first_day` and `last_day` of the one-row `bounds`."""
    days = bounds.select(
        F.explode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("full_date")
    )
    d = F.col("full_date")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_sk"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.date_format(d, "EEEE").alias("day_of_week"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )
