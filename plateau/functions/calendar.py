"""Calendar expressions (F03-F05, F17, F18). All times are UTC wall times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plateau.functions.common import as_col

_US_PER_DAY = 86_400_000_000


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def whole_days_between(start, end) -> Column:
    """floor((end - start) / 1 day), the pandas ``Timedelta.days`` of end - start."""
    return F.floor((epoch_us(as_col(end)) - epoch_us(as_col(start))) / F.lit(_US_PER_DAY)).cast("bigint")


def fractional_days_between(start, end) -> Column:
    return ((epoch_us(as_col(end)) - epoch_us(as_col(start))) / F.lit(float(_US_PER_DAY))).cast("double")


def from_epoch(seconds) -> Column:
    """Epoch seconds -> timestamp (NULL stays NULL)."""
    return F.timestamp_seconds(as_col(seconds))


def time_of_day(ts) -> Column:
    """5-11 morning, 12-16 afternoon, 17-20 evening, else night; NULL -> 'unknown' (F03)."""
    h = F.hour(as_col(ts))
    return (F.when(h.isNull(), "unknown").when((h >= 5) & (h < 12), "morning")
            .when((h >= 12) & (h < 17), "afternoon").when((h >= 17) & (h < 21), "evening")
            .otherwise("night"))


def day_of_week(ts) -> Column:
    """Weekday name (Monday ...); NULL -> 'unknown' (F04)."""
    return F.coalesce(F.date_format(as_col(ts), "EEEE"), F.lit("unknown"))


def is_weekend(ts) -> Column:
    """Saturday/Sunday flag; NULL when the time is unknown."""
    return F.weekday(as_col(ts)) >= 5


def with_calendar(df, ts_col: str = "datetime"):
    """Date, hour, weekday, month, year columns of a timestamp."""
    ts = F.col(ts_col)
    return df.withColumns({
        "date": F.to_date(ts),
        "hour": F.hour(ts).cast("bigint"),
        "day_of_week": F.date_format(ts, "EEEE"),
        "month": F.month(ts).cast("bigint"),
        "year": F.year(ts).cast("bigint"),
    })


def context_features(ts) -> dict[str, Column]:
    """Context at a time (F18): hour, weekday (Mon=0), month, weekend and meal flags, season."""
    t = as_col(ts)
    h, wd, m = F.hour(t), F.weekday(t), F.month(t)
    season = (F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring")
              .when(m.isin(6, 7, 8), "summer").otherwise("autumn"))
    return {
        "hour": h.cast("bigint"),
        "day_of_week": wd.cast("bigint"),
        "month": m.cast("bigint"),
        "is_weekend": (wd >= 5).cast("bigint"),
        "is_breakfast_time": ((h >= 6) & (h <= 10)).cast("bigint"),
        "is_lunch_time": ((h >= 11) & (h <= 14)).cast("bigint"),
        "is_dinner_time": ((h >= 17) & (h <= 21)).cast("bigint"),
        "season": season,
        "is_winter": (season == "winter").cast("bigint"),
        "is_spring": (season == "spring").cast("bigint"),
        "is_summer": (season == "summer").cast("bigint"),
        "is_autumn": (season == "autumn").cast("bigint"),
    }


def parse_iso(c) -> Column:
    """ISO-8601 text -> timestamp; invalid -> NULL."""
    return F.try_to_timestamp(as_col(c).cast("string"))
