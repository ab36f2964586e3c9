"""Calendar arithmetic. Nothing here reads the clock: callers pass ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etlkit.runtime import require

__all__ = [
    "date_math", "date_parts", "format_date", "from_utc", "is_weekend", "next_business_day",
    "parse_date", "quarter_start", "stamp", "time_parts", "to_utc", "with_date_parts",
]

# The three output styles.
STYLES = {"iso": "yyyy-MM-dd", "us": "MM/dd/yyyy", "verbose": "MMMM dd, yyyy"}


def stamp(df: DataFrame, as_of: Column) -> DataFrame:
    """Add processing timestamp, date, formatted date and time, and epoch seconds of ``as_of``."""
    at = as_of.cast("timestamp")
    return df.withColumns({
        "processing_timestamp": at.cast("timestamp_ntz"),
        "processing_date": F.to_date(at),
        "processing_date_text": F.date_format(at, "yyyy-MM-dd"),
        "processing_time_text": F.date_format(at, "HH:mm:ss"),
        "processing_unix": F.unix_timestamp(at),
    })


def date_math(day: Column, as_of: Column) -> dict[str, Column]:
    """Shifts of ``day`` and its distance to ``as_of``."""
    return {
        "date_plus_30": F.date_add(day, 30),
        "date_minus_7": F.date_sub(day, 7),
        "days_since": F.datediff(as_of, day),
        "months_since": F.months_between(as_of, day),
    }


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "week_of_year": F.weekofyear(day),
        "day_of_week": F.dayofweek(day),
        "day_of_year": F.dayofyear(day),
    }


def time_parts(ts: Column) -> dict[str, Column]:
    return {"hour": F.hour(ts), "minute": F.minute(ts), "second": F.second(ts)}


def with_date_parts(df: DataFrame, ts: str) -> DataFrame:
    """Add year, month and day columns for a partitioned layout."""
    require(df, ts)
    return df.withColumns({"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)})


def to_utc(ts: Column, zone: Column | str) -> Column:
    """Wall time in ``zone`` (a region id, or a column of them) to UTC wall time."""
    return F.to_utc_timestamp(ts, zone)


def from_utc(ts: Column, zone: Column | str) -> Column:
    return F.from_utc_timestamp(ts, zone)


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def next_business_day(day: Column) -> Column:
    """Saturday and Sunday move to Monday; other days stay."""
    return (
        F.when(F.dayofweek(day) == 7, F.date_add(day, 2))
        .when(F.dayofweek(day) == 1, F.date_add(day, 1))
        .otherwise(F.to_date(day))
    )


def quarter_start(day: Column) -> Column:
    return F.trunc(F.to_date(day), "quarter")


def parse_date(text: Column, fmt: str = "MM/dd/yyyy") -> Column:
    """Date from text; NULL when the text does not match."""
    return F.to_date(F.try_to_timestamp(text, F.lit(fmt)))


def format_date(day: Column, style: str = "iso") -> Column:
    if style not in STYLES:
        raise ValueError(f"style must be one of {sorted(STYLES)}")
    return F.date_format(day, STYLES[style])
