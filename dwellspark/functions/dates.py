"""Dates and durations."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from dwellspark import constants as K
from dwellspark.functions.text import is_empty, number, strip

_PYTHON_FORMATS = (
    "%d.%m.%Y", "%d.%m.%y", "%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d-%m-%Y", "%Y.%m.%d", "%Y/%m/%d", "%Y%m%d",
    "%d %b %Y", "%d %B %Y", "%b %d, %Y", "%B %d, %Y",
)
#: Two separators between digits: a date, never a number. Told apart first, because a failed cast throws for every row.
_DATED = r"^\d+[./-]\d+[./-]"
_TIME = r"([T ]+\d{1,2}:\d{2}(:\d{2}([.,]\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?)$"


def parse_date(
    c: Column,
    patterns: Sequence[str] = K.DATE_PATTERNS,
    origin: str = K.SERIAL_DATE_ORIGIN,
    empty: Sequence[str] = K.EMPTY_DATE,
) -> Column:
    """Date from text: a day serial in range, or the first pattern that fits; else null."""
    low, high = K.SERIAL_DATE_RANGE

    def read(text: Column) -> Column:
        serial = F.when(~text.rlike(_DATED), number(text))
        day = F.initcap(F.regexp_replace(text, _TIME, ""))
        parsed = F.coalesce(*[F.when(text.rlike(_shape(p)), _by_pattern(day, p)) for p in patterns])
        in_range = F.when(serial.between(low, high + 1), F.floor(serial).cast("int"))
        return F.when(~is_empty(text, empty), F.coalesce(F.date_add(F.lit(origin).cast("date"), in_range), parsed))

    # As an element the text is trimmed once, and the code of all patterns stays out of the generated method of
    # the stage, which is interpreted when it grows too long to be compiled.
    return F.get(F.transform(F.array(strip(c)), read), F.lit(0))


def _shape(pattern: str) -> str:
    """What a text must look like to be tried with the pattern; a failed try throws for every row."""
    if set(pattern) & set("[]{}'#"):
        return ""
    fields = {"yyyy": r"[+-]?\d{4,}", "yy": r"\d\d", "d": r"[+-]?\d+", "M": r"[+-]?\d+", "MM": r"\d\d", "dd": r"\d\d"}
    runs = re.finditer(r"([A-Za-z])\1*|[^A-Za-z]+", pattern)
    shape = "".join(fields.get(r[0], ".+") if r[1] else re.escape(r[0]) for r in runs)
    return rf"^{shape}(?:$|[T ])"


def _by_pattern(day: Column, pattern: str) -> Column:
    value = F.try_to_timestamp(day, F.lit(pattern)).cast("date")
    if "yyyy" in pattern:
        return value
    # Two-digit years from 69 on belong to the last century.
    return F.when(F.year(value) > 2068, F.add_months(value, -1200)).otherwise(value)


def date_value(value: Any) -> dt.date | None:
    """The same reading for one literal of a filter description."""
    if value is None:
        return None
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    text = str(value).strip()
    low, high = K.SERIAL_DATE_RANGE
    try:
        if low <= float(text) <= high + 1:
            return dt.date.fromisoformat(K.SERIAL_DATE_ORIGIN) + dt.timedelta(days=int(float(text)))
    except ValueError:
        pass
    day = re.sub(_TIME, "", text)
    for fmt in _PYTHON_FORMATS:
        try:
            return dt.datetime.strptime(day, fmt).date()
        except ValueError:
            continue
    return None


def stage_days(
    report_date: Column, work_start: Column, deal_created: Column, deal_stage: Column,
    empty: Sequence[str] = K.EMPTY_STAGE,
) -> Column:
    """Days on stage from dates: since the deal when there is a deal stage, else since the start."""
    since = F.when(~is_empty(deal_stage, empty), F.coalesce(deal_created, work_start)).otherwise(work_start)
    return F.datediff(report_date, since).cast("double")
