"""Built-in column expressions only, so every one stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date texts that are read, after surrounding spaces are cut: a day with a time down to minutes,
# seconds or fractions, after a space or a T; or eight digits. A bare year is no date.
DATE_FORM = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
DIGITS_FORM = r"^\d{8}$"

# The order states that count as canceled.
CANCELED_STATES = ("canceled", "unavailable")

# Fixed value: the label of a missing or untranslated category.
UNKNOWN = "Unknown"


def column(name: str) -> Column:
    """A column by its exact name, which may hold dots, spaces or back ticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def parse_timestamp(text: Column) -> Column:
    """Timestamp without zone, or NULL for text that is not a date; judged by its form, never by its length.

    Fractions are cut to microseconds, minutes get their seconds and eight digits their hyphens before the cast, which
    then decides whether such a day or time exists.
    """
    trimmed = F.trim(text)
    seconds = F.when(F.length(trimmed) == 16, F.concat(trimmed, F.lit(":00"))).otherwise(F.substring(trimmed, 1, 26))
    hyphens = F.regexp_replace(trimmed, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    written = F.when(trimmed.rlike(DATE_FORM), seconds).when(trimmed.rlike(DIGITS_FORM), hyphens)
    return written.try_cast("timestamp_ntz")


def is_invalid_date(text: Column) -> Column:
    return text.isNotNull() & parse_timestamp(text).isNull()


def date_key(moment: Column) -> Column:
    """The day as an integer yyyyMMdd; NULL stays NULL."""
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


def day_count(start: Column, end: Column) -> Column:
    """Number of midnights between two moments, negative when `end` is earlier."""
    return F.datediff(end, start)


def clean_place(name: Column) -> Column:
    """Upper case without surrounding spaces; other white space is kept."""
    return F.upper(F.trim(name))


def text_length(text: Column) -> Column:
    """Length without trailing spaces."""
    return F.length(F.rtrim(text))


def flag(condition: Column) -> Column:
    """1 when the condition holds, 0 when it does not or is NULL."""
    return F.when(condition, 1).otherwise(0)


def or_unknown(text: Column) -> Column:
    return F.coalesce(text, F.lit(UNKNOWN))


def display(value: Column) -> Column:
    """Text for a report, '-' when there is no value."""
    return F.coalesce(value.cast("string"), F.lit("-"))


def ratio(part: Column, whole: Column) -> Column:
    """Division as double, NULL when there is nothing to divide by."""
    return F.try_divide(part.cast("double"), whole.cast("double"))
