"""Loading of team rosters and of the contact directory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.functions.text import tab_number
from dwellspark.operators.teams import contact_lookup, leaders_only
from dwellspark.sources.reports import find_column, read_files

# Headers of the roster and of the contact file.
ROSTER_HEADERS = {
    "report_date": "Дата отчета",
    "team_added_date": "Дата добавления в команду",
    "lead_id": "ID ПрПр",
    "deal_id": "ID сделки",
    "member_tab_number": "Табельный номер участника команды",
    "member": "Участник команды",
    "role": "Роль участника команды",
    "is_leader": "Лидер",
    "tb": "ТБ",
    "team_type": "Тип команды",
}
CONTACT_HEADERS = {
    "tab_number": "Табельный номер",
    "email_alpha": "Почта Альфа",
    "email_sigma": "Почта Сигма",
}
ROSTER_REQUIRED = ("member", "is_leader")


def team_columns(df: DataFrame, headers: dict[str, str] = ROSTER_HEADERS) -> DataFrame:
    """Canonical roster columns: headers trimmed, columns without a name dropped."""
    found = {key: find_column(df.columns, header) for key, header in headers.items()}
    missing = [headers[k] for k in ROSTER_REQUIRED if not found.get(k)]
    if missing:
        raise ValueError("missing roster columns: " + ", ".join(missing))
    extra = [c for c in ("source_file", "seq") if c in df.columns]
    out = df.select(*[F.col(f"`{h}`").alias(k) for k, h in found.items() if h], *extra)
    if "member_tab_number" in out.columns:
        out = out.withColumn("member_tab_number", tab_number(F.col("member_tab_number")))
    return out


def load_team(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str = "parquet",
    headers: dict[str, str] = ROSTER_HEADERS,
    keep_leaders_only: bool = False,
    **options,
) -> DataFrame:
    """Roster rows of all files; with `keep_leaders_only` the others are dropped while reading."""
    team = team_columns(read_files(spark, paths, fmt, **options), headers)
    return leaders_only(team) if keep_leaders_only else team


def load_contacts(
    spark: SparkSession, paths: Sequence[str], headers: dict[str, str] = CONTACT_HEADERS, sep: str = ";"
) -> DataFrame:
    """Contact directory from delimited text: one row per tab number."""
    raw = read_files(spark, paths, "csv", sep=sep, header="true")
    # A byte order mark may stick to the first header.
    raw = raw.toDF(*[c.replace("﻿", "").strip() for c in raw.columns])
    columns = {key: find_column(raw.columns, header) for key, header in headers.items()}
    missing = [headers[k] for k, h in columns.items() if not h]
    if missing:
        raise ValueError("missing contact columns: " + ", ".join(missing))
    return contact_lookup(raw.select(*[F.col(f"`{h}`").alias(k) for k, h in columns.items()], "seq"))
