"""Dates in mixed notations, ISO-8601 instants, and calendar attributes.

The text passed to the parsers must be trimmed already, with blank turned into NULL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import Parsed

# Shape of the text -> formats to try on it, in order of preference.
# The first four rows are the documented notations; month-first wins when ambiguous.
DATE_NOTATIONS = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", ("yyyy-M-d",)),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}$", ("d-MMM-yyyy",)),
    (r"^\d{1,2}/\d{1,2}/\d{4}$", ("M/d/yyyy", "d/M/yyyy")),
    (r"^\d{8}$", ("yyyyMMdd",)),
    (r"^\d{1,2}-[A-Za-z]{4,9}-\d{4}$", ("d-MMMM-yyyy",)),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}$", ("MMM d, yyyy",)),
    (r"^[A-Za-z]{4,9} \d{1,2}, \d{4}$", ("MMMM d, yyyy",)),
    (r"^[A-Za-z]{3} \d{1,2} \d{4}$", ("MMM d yyyy",)),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", ("d MMM yyyy",)),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", ("d MMMM yyyy",)),
    (r"^\d{4}/\d{1,2}/\d{1,2}$", ("yyyy/M/d",)),
    (r"^\d{4}\.\d{1,2}\.\d{1,2}$", ("yyyy.M.d",)),
    (r"^\d{1,2}-\d{1,2}-\d{4}$", ("M-d-yyyy", "d-M-yyyy")),
    (r"^\d{1,2}\.\d{1,2}\.\d{4}$", ("M.d.yyyy", "d.M.yyyy")),
    (r"^\d{1,2}/\d{1,2}/\d{2}$", ("M/d/yy", "d/M/yy")),
    (r"^\d{1,2}-\d{1,2}-\d{2}$", ("M-d-yy", "d-M-yy")),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{2}$", ("d-MMM-yy",)),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$", ("M/d/yyyy H:mm", "d/M/yyyy H:mm")),
    (r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$", ("M/d/yyyy H:mm:ss", "d/M/yyyy H:mm:ss")),
)
# Years of two digits are of this century up to here, of the last one after it.
LAST_SHORT_YEAR = 2075
ISO_DATE_WITH_TIME = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"

# ISO-8601 shape -> the same instant written in full ($0 is the whole text).
INSTANT_NOTATIONS = (
    (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$", "$0"),
    (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?$", "$0Z"),
    (r"^\d{4}-\d{2}-\d{2}$", "$0T00:00:00Z"),
    (r"^(\d{4})(\d{2})(\d{2})[T ](\d{2})(\d{2})(\d{2}(?:\.\d+)?)Z?$", "$1-$2-$3T$4:$5:$6Z"),
    (r"^(\d{4})(\d{2})(\d{2})[T ](\d{2})(\d{2})(\d{2}(?:\.\d+)?)([+-]\d{2}):?(\d{2})$",
     "$1-$2-$3T$4:$5:$6$7:$8"),
    (r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?[+-]\d{2})(\d{2})$", "$1:$2"),
    (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d+)?[+-]\d{2}$", "$0:00"),
    (r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}$", "$0:00Z"),
    (r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})(Z|[+-]\d{2}:\d{2})$", "$1:00$2"),
    (r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})([+-]\d{2})(\d{2})$", "$1:00$2:$3"),
    (r"^(\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2})([+-]\d{2})$", "$1:00$2:00"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3T00:00:00Z"),
    (r"^\d{4}-\d{2}$", "$0-01T00:00:00Z"),
    (r"^\d{4}$", "$0-01-01T00:00:00Z"),
)


# So many notations, the usual ones, are looked for in generated code.
USUAL = 4


def _chosen(text: Column, cases: list[tuple[str, Column]]) -> Column:
    value = F.when(F.lit(False), cases[0][1])
    for shape, parsed in cases:
        value = value.when(text.rlike(shape), parsed)
    return value


def _first_shape(text: Column, cases: Callable[[Column], list[tuple[str, Column]]]) -> Column:
    """What the first shape that `text` has makes of it.

    The unusual shapes are tried inside a `transform`, which Spark interprets: the code it would
    generate for all of them is too large to be compiled, and all other columns would suffer.
    """
    unusual = F.transform(F.array(text), lambda t: _chosen(t, cases(t)[USUAL:]))
    usual = _chosen(text, cases(text)[:USUAL])
    return usual.when(text.isNotNull(), F.get(unusual, F.lit(0)))


def parse_date(text: Column) -> Parsed:
    """DATE from text. The shape picks the format, so one value is parsed once or twice."""
    text = F.when(text.contains("ept"), F.regexp_replace(text, r"(?i)\bsept\b", "Sep")).otherwise(text)

    def day(text: Column, formats: tuple[str, ...]) -> Column:
        found = F.coalesce(*[F.try_to_date(text, f) for f in formats])
        short = not any("yyyy" in f for f in formats)
        return F.when(F.year(found) > LAST_SHORT_YEAR, F.add_months(found, -1200)).otherwise(found) if short else found

    def cases(text: Column) -> list[tuple[str, Column]]:
        # The whole text must be an instant; its own day counts, whatever its zone.
        instant = parse_timestamp(text).value
        return [*[(shape, day(text, formats)) for shape, formats in DATE_NOTATIONS],
                (ISO_DATE_WITH_TIME, F.when(instant.isNotNull(), F.substring(text, 1, 10).try_cast("date")))]

    value = _first_shape(text, cases)
    return Parsed(value, text.isNotNull() & value.isNull())


def parse_timestamp(text: Column) -> Parsed:
    """Instant from ISO-8601 text; text without a zone is taken as UTC."""
    dotted = F.replace(text, F.lit(","), F.lit("."))
    value = _first_shape(dotted, lambda t: [
        (shape, (t if full == "$0" else F.regexp_replace(t, shape, full)).try_cast("timestamp"))
        for shape, full in INSTANT_NOTATIONS
    ])
    return Parsed(value, text.isNotNull() & value.isNull())


def calendar_columns(d: Column) -> dict[str, Column]:
    """Attributes of a calendar day; weeks and weekdays follow ISO-8601."""
    weekday = F.weekday(d) + 1
    return {
        "date_id": F.date_format(d, "yyyyMMdd").cast("int"),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": weekday,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": weekday >= 6,
        "is_month_end": F.last_day(d) == d,
    }
