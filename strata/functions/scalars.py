"""Time, text and label expressions shared by the operators."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the instant format of the event producers (ISO-8601, micros, offset).
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"

# Right-closed score bins (0, .33], (.33, .66], (.66, 1].
SEGMENTS = (("low", 0.0, 0.33), ("medium", 0.33, 0.66), ("high", 0.66, 1.0))


def parse_instant(text: Column) -> Column:
    """ISO-8601 text to timestamp, NULL when unreadable (also under ANSI mode)."""
    return F.try_to_timestamp(text)


def iso_instant(ts: Column) -> Column:
    """Timestamp to ISO-8601 text; to_json alone would cut it to milliseconds."""
    return F.date_format(ts, ISO_INSTANT)


def padded_id(prefix: str, number: Column, width: int) -> Column:
    """Id such as U00042. Longer numbers keep all their digits (lpad would cut them)."""
    return F.format_string(f"{prefix}%0{width}d", number.cast("bigint"))


def day(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def cents(amount: Column) -> Column:
    return F.round(amount, 2)


def rate(part: Column, whole: Column) -> Column:
    """part / (whole + 1), four digits. The 1 keeps an empty whole from dividing by zero."""
    return F.round(part / (whole + F.lit(1)), 4)


def segment(score: Column) -> Column:
    """Label of the score's bin; a score of exactly 0, above 1 or NULL has none."""
    return F.coalesce(*[
        F.when((score > F.lit(low)) & (score <= F.lit(high)), F.lit(name))
        for name, low, high in SEGMENTS
    ])


def key_hash(key: Column, seed: int) -> Column:
    """32-bit hash of a key and a seed, from md5 so that any engine can reproduce it."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
