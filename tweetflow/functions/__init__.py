"""Column expressions shared by the operators. All of them run on the JVM side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
# Times are read up to the year 9999, and as far back from 1970.
LAST_MS = 253_402_300_799_999
INT_MAX = 2**31 - 1
INT_MIN = -(2**31)


def epoch_ms(name: str) -> Column:
    """Epoch millis of a zone-free timestamp column, rounded down, whatever the session's zone."""
    # Subtracting two zone-free timestamps stays zone-free; timestampdiff would go through the session's
    # zone and be an hour off for times that its clock change skips.
    since = f"{name} - timestamp_ntz'1970-01-01 00:00:00'"
    return F.floor(F.expr(f"cast(cast({since} as interval second) as decimal(18, 6))") * 1000).cast("bigint")


def floor_div(value: Column, divisor: int) -> Column:
    """Whole-number division that rounds down."""
    down = F.when((value < 0) & (value % divisor != 0), 1).otherwise(0)
    return F.call_function("div", value, F.lit(divisor).cast("bigint")) - down


def millis(text: Column) -> Column:
    """Quoted epoch millis as a number; NULL where the text is no number, or one beyond the days that dates can hold."""
    number = text.try_cast("bigint")
    return F.when(F.abs(number.cast("decimal(20, 0)")) <= LAST_MS, number)


def epoch_ms_to_date(ms: Column) -> Column:
    """The UTC day as yyyy-MM-dd text."""
    return F.date_from_unix_date(floor_div(ms, DAY_MS).try_cast("int")).cast("string")


def same_ignoring_case(value: Column, wanted: str) -> Column:
    return F.lower(value) == wanted.lower()


def contains_ignoring_case(value: Column, word: str) -> Column:
    return F.contains(F.upper(value), F.lit(word.upper()))


def media_text(media: Column) -> Column:
    """``(id,url)`` pairs joined by commas; empty when there are none or any pair is incomplete."""
    incomplete = F.exists(media, lambda m: m["id_str"].isNull() | m["media_url"].isNull())
    pairs = F.transform(media, lambda m: F.concat(F.lit("("), m["id_str"], F.lit(","), m["media_url"], F.lit(")")))
    return F.when(media.isNull() | incomplete, F.lit("")).otherwise(F.array_join(pairs, ","))


def hashtag_text(hashtags: Column) -> Column:
    return F.array_join(F.transform(hashtags, lambda h: h["text"]), ",")


def to_int_clamped(value: Column) -> Column:
    """A whole number as int, held at the ends of the 32-bit range instead of overflowing; NULL stays."""
    held = F.greatest(F.least(value, F.lit(INT_MAX)), F.lit(INT_MIN))
    return F.when(value.isNotNull(), held).cast("int")


def json_record(*columns: str) -> Column:
    """A JSON object text with every column, NULL ones included."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
