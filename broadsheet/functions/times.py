"""Column functions on time."""

from pyspark.sql import Column, functions as F

from broadsheet.settings import PUBLISH_PATTERN, SLOT_HOURS

EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def parse_publish_time(text: Column) -> Column:
    """Publish time of an article; the epoch where the text cannot be read."""
    parsed = F.try_to_timestamp(text, F.lit(PUBLISH_PATTERN)).cast("timestamp_ntz")
    return F.coalesce(parsed, F.expr(EPOCH))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def age_hours(publish_ts: Column, as_of: Column) -> Column:
    """Whole hours between two times."""
    return F.timestamp_diff("HOUR", publish_ts, as_of)


def hours_between(start: Column, end: Column) -> Column:
    """Hours between two times, with their fraction."""
    return (epoch_micros(end) - epoch_micros(start)) / F.lit(3.6e9)


def hour_slot(ts: Column, slot_hours: int = SLOT_HOURS) -> Column:
    return F.floor(F.hour(ts) / F.lit(slot_hours)).cast("bigint")
