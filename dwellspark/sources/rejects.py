"""Values that cannot be read, beside the table in which they became null.

`with_faults` is `normalize_reports` with one more column, the faults of a row. The table goes on
without that column, and the faults become a table of their own; both come from one reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspark import constants as K
from dwellspark.functions.text import is_empty
from dwellspark.sources.folders import CORRUPT
from dwellspark.sources.reports import REPORT_SCHEMA, normalize_reports

FAULTS = "_faults"
#: Reasons, by the kind of a column.
UNREADABLE = {"date": "unreadable date", "number": "unreadable number", "flag": "unreadable number"}
NO_LEAD, BROKEN_LINE = "no lead", "line does not fit its header"


def _fault(name: str, value: Column, reason: str, when: Column) -> Column:
    found = F.struct(F.lit(name).alias("column"), value.cast("string").alias("value"), F.lit(reason).alias("reason"))
    return F.when(when, found)


def with_faults(
    df: DataFrame, dates: Sequence[str] = K.DATE_PATTERNS, empty_tokens: Sequence[str] = K.EMPTY_DATE
) -> DataFrame:
    """`normalize_reports` of `df` with `_faults`: column, value as it was read, reason.

    A value is at fault if it says something and nothing could be read from it; a row, if it has no
    lead; a text line, if it has more or fewer values than its header. Rows stay whatever their faults.
    """
    raw = df.select("*", F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_raw"))
    plain = normalize_reports(raw, dates, empty_tokens)
    faults = []
    for field in df.schema.fields:
        before, after = F.col("_raw").getField(field.name), F.col(field.name)
        kind = REPORT_SCHEMA.get(field.name)
        if kind in UNREADABLE and isinstance(field.dataType, T.StringType):
            empty = is_empty(before, empty_tokens if kind == "date" else K.EMPTY_STAGE)
            faults.append(_fault(field.name, before, UNREADABLE[kind], ~empty & after.isNull()))
        if field.name == "lead_id":
            faults.append(_fault(field.name, before, NO_LEAD, is_empty(after)))
        if field.name == CORRUPT:
            faults.append(_fault(field.name, before, BROKEN_LINE, before.isNotNull()))
    listed = F.array_compact(F.array(*faults)) if faults else F.array()
    kind = "array<struct<column:string,value:string,reason:string>>"
    # A column that is not deterministic keeps filters on the faults above it; moved below, they would read every
    # value a second time.
    once = F.when(F.monotonically_increasing_id() >= 0, listed.cast(kind))
    return plain.withColumn(FAULTS, once).drop("_raw", CORRUPT)


def accepted(checked: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """The table itself: all rows, or those without faults of the given reasons."""
    rows = checked
    if without:
        rows = rows.filter(~F.exists(FAULTS, lambda f: f["reason"].isin(list(without))))
    return rows.drop(FAULTS)


def quarantine(checked: DataFrame) -> DataFrame:
    """One row per fault: `source_file, seq, column, value, reason`."""
    return checked.select("source_file", "seq", F.inline(FAULTS))


def fault_counts(checked: DataFrame, by: Sequence[str] = ("source_file",)) -> DataFrame:
    """Faults per file, column and reason."""
    listed = checked.select(*by, F.inline(FAULTS))
    return listed.groupBy(*by, "column", "reason").agg(F.count(F.lit(1)).alias("faults"))


def file_counts(checked: DataFrame, by: Sequence[str] = ("source_file",)) -> DataFrame:
    """Per file its rows and those with a fault: the log of a load."""
    return checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("file_rows"), F.count_if(F.size(FAULTS) > 0).alias("faulty_rows")
    )
