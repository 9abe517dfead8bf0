"""Last known state of every lead: per field the newest value that is not empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspark import constants as K
from dwellspark.functions.text import client_name, is_empty, strip

FIELDS = (
    "product_group",
    "product",
    "current_status",
    "inn",
    "client_id",
    "client",
    "work_start_date",
    "deal_id",
    "deal_created_date",
    "sales_method",
    "deal_stage",
    "tb",
    "gosb",
    "km",
    "vks",
)
LATEST_ONLY = ("sales_method",)

_NO_DATE = 2**31 - 1


def newest_first(report_date: str, seq: str) -> Column:
    """Order of the rows of a lead: newest date first, rows without a date last, then row order."""
    age = F.coalesce(-F.unix_date(F.col(report_date)), F.lit(_NO_DATE))
    return F.struct(age.alias("age"), F.col(seq).alias("seq"))


def lead_snapshot(
    df: DataFrame,
    fields: Sequence[str] = FIELDS,
    latest_only: Sequence[str] = LATEST_ONLY,
    seq: str = "seq",
    shorten_clients: bool = True,
) -> DataFrame:
    """One row per lead. One aggregation, no window: a hot lead is reduced before the shuffle."""
    fields = [f for f in fields if f in df.columns]
    order = newest_first("report_date", seq)
    lead = strip(F.col("lead_id"))
    work = df.filter(lead != "").withColumns({"lead_id": lead, "_order": order})

    def newest(name: str) -> Column:
        if name in latest_only:
            return F.min_by(name, "_order")
        # Only text can spell a missing value.
        text = isinstance(df.schema[name].dataType, T.StringType)
        filled = ~is_empty(F.col(name), K.EMPTY_SNAPSHOT) if text else F.col(name).isNotNull()
        return F.min_by(F.col(name), F.when(filled, F.col("_order")))

    snap = work.groupBy("lead_id").agg(
        F.max("report_date").alias("report_date"),
        F.min_by(F.col("days_on_stage").cast("double"), F.col("_order")).alias("days_on_stage"),
        *[newest(f).alias(f) for f in fields],
    )
    if shorten_clients and "client" in fields:
        snap = snap.withColumn("client", client_name(F.col("client")))
    return snap


def snapshot_export(
    snap: DataFrame,
    fields: Sequence[str] = FIELDS,
    status_columns: Sequence[str] = (),
    labels: dict[str, str] | None = None,
) -> DataFrame:
    """Columns in the order of the sheet: status days after the status, the norm columns,
    then the leaders with the contacts after the name."""
    order = ["lead_id"]
    for f in fields:
        if f in snap.columns:
            order.append(f)
            if f == "current_status":
                order += [c for c in status_columns if c in snap.columns]
    order += [c for c in ("norm_days", "current_days", "exceeded_flag", "exceeded_days") if c in snap.columns]
    for who in ("lead", "deal"):
        block = ("tab_numbers", "members", "email_alpha", "email_sigma", "roles", "tbs")
        order += [f"{who}_leader_{c}" for c in block if f"{who}_leader_{c}" in snap.columns]
    labels = labels or {}
    return snap.select(*[F.col(f"`{c}`").alias(labels.get(c, c)) for c in order])
