"""Loading of stage reports: many files, one canonical table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspark import constants as K
from dwellspark.functions.dates import parse_date
from dwellspark.functions.text import double_id, number, source_category, strip, text_id

# Canonical columns of a stage report. A file maps its own headers onto them.
REPORT_SCHEMA = {
    "report_date": "date",
    "lead_id": "id",
    "product_group": "text",
    "product": "text",
    "inn": "id",
    "client_id": "id",
    "client": "raw",
    "work_start_date": "date",
    "current_status": "text",
    "days_on_stage": "number",
    "deal_id": "id",
    "source_deal_id": "id",
    "deal_created_date": "date",
    "deal_stage": "text",
    "days_since_deal": "number",
    "tb_code": "id",
    "tb": "text",
    "gosb": "raw",
    "km": "text",
    "vks": "raw",
    "label": "raw",
    "change_conditions": "flag",
    "data_entry": "flag",
    "efs_flag": "flag",
    "sales_method": "raw",
}
REQUIRED = (
    "report_date",
    "lead_id",
    "product_group",
    "product",
    "work_start_date",
    "current_status",
    "days_on_stage",
    "deal_created_date",
    "deal_stage",
    "days_since_deal",
    "tb",
)


def find_column(columns: Sequence[str], wanted: str) -> str | None:
    """A header as it is, else trimmed, else trimmed without regard to case."""
    for same in (lambda c: c, lambda c: c.strip(), lambda c: c.strip().lower()):
        for c in columns:
            if same(c) == same(wanted):
                return c
    return None


def project_required(
    df: DataFrame,
    columns: dict[str, str],
    required: Sequence[str] = REQUIRED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Canonical names for the mapped headers; a missing required one fails before any job."""
    found = {key: find_column(df.columns, header) for key, header in columns.items()}
    missing = [f"{k} ({columns.get(k, k)})" for k in required if not found.get(k)]
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return df.select(
        *[F.col(f"`{header}`").alias(key) for key, header in found.items() if header], *keep
    )


def read_files(
    spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", schema: str | T.StructType | None = None,
    **options,
) -> DataFrame:
    """Rows of all files with the file name and a row order that is the same in every run.

    Parquet rows carry their index in the file; text formats use the position of
    the split and the row inside it.
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(list(paths))
    name = F.col("_metadata.file_name").alias("source_file")
    # Names before paths, so moving a folder changes no order; hashes, because the order goes
    # through every later aggregation.
    file = F.struct(F.xxhash64("_metadata.file_name").alias("name"), F.xxhash64("_metadata.file_path").alias("path")).alias("file")
    if fmt == "parquet":
        place = F.struct(file, F.col("_metadata.row_index").alias("line"))
    else:
        place = F.struct(
            file, F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
        )
    return df.select("*", name, place.alias("seq"))


def load_reports(
    spark: SparkSession,
    sources: Sequence[tuple[str | Sequence[str], dict[str, str]]],
    fmt: str = "parquet",
    required: Sequence[str] = REQUIRED,
    **options,
) -> DataFrame:
    """Union of report files with different headers. Every row stays; absent columns are null.

    `sources` pairs paths with the header map of their files.
    """
    parts = []
    for paths, columns in sources:
        df = read_files(spark, [paths] if isinstance(paths, str) else paths, fmt, **options)
        parts.append(project_required(df, columns, required, ("source_file", "seq")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def normalize_reports(
    df: DataFrame, dates: Sequence[str] = K.DATE_PATTERNS, empty_tokens: Sequence[str] = K.EMPTY_DATE
) -> DataFrame:
    """Types of a stage report: dates, numbers, flags, trimmed text, identifiers as text.

    `dates` are the date patterns in order, `empty_tokens` the texts that stand for no date.
    """
    out = []
    for field in df.schema.fields:
        c, dtype = F.col(field.name), field.dataType
        kind = REPORT_SCHEMA.get(field.name)
        if kind == "date":
            dated = isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType))
            c = c.cast("date") if dated else parse_date(c, dates, empty=empty_tokens)
        elif kind == "number":
            c = number(c) if not isinstance(dtype, T.NumericType) else F.nanvl(c.cast("double"), F.lit(None).cast("double"))
        elif kind == "flag":
            c = c.cast("int") if isinstance(dtype, T.IntegralType) else number(c).cast("int")
        elif kind == "text":
            c = strip(c)
        elif kind == "id":
            c = double_id(c) if isinstance(dtype, (T.DoubleType, T.FloatType)) else text_id(c)
        out.append(c.alias(field.name))
    return df.select(*out)


def with_category(df: DataFrame, markers: Sequence[tuple[str, str]], unknown: str = "UNKNOWN") -> DataFrame:
    return df.withColumn("category", source_category(F.col("source_file"), markers, unknown))
