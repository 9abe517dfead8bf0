"""Writers. Every file is written by the task that holds its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspark.functions.output import json_safe, sanitize
from dwellspark.session import materialise

ROW_LIMIT = 900_000
#: A quote inside a quoted value is doubled, so a backslash is a character like any other; blanks at the
#: edges of a value belong to it. Writer and reader have to agree on these.
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", by: str | None = None, row_limit: int = ROW_LIMIT,
    sep: str = ";", mode: str = "overwrite",
) -> None:
    """A table in the format asked for, at most `row_limit` rows per file; `by` gives a folder per value.

    Mode `replace` rewrites the folders of the values that are in `df` and leaves the others alone.

    CSV has a header and clean values, which `read_csv` reads back as they were written (an empty text
    comes back as null); JSON has no NaN.
    """
    clean = {"csv": sanitize, "json": json_safe}.get(fmt, lambda x: x)(df)
    writer = _mode(clean, mode, by).option("maxRecordsPerFile", row_limit)
    if by is not None:
        writer = writer.partitionBy(by)
    if fmt == "csv":
        writer = writer.options(**CSV, sep=sep)
    writer.format(fmt).save(path)


def write_csv(df: DataFrame, path: str, sep: str = ";", row_limit: int = ROW_LIMIT, mode: str = "overwrite") -> None:
    """Delimited text with a header."""
    write_table(df, path, "csv", None, row_limit, sep, mode)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, sep: str = ";") -> DataFrame:
    """What `write_csv` has written. Line breaks inside quotes belong to the value, and it has any length."""
    options = {**CSV, "sep": sep, "multiLine": True, "lineSep": "\n", "maxCharsPerColumn": -1}
    return spark.read.options(**options).schema(schema).csv(path)


def write_split(
    df: DataFrame, path: str, by: str = "tb", fmt: str = "parquet", row_limit: int = ROW_LIMIT,
    mode: str = "overwrite",
) -> None:
    """One folder per territory."""
    write_table(df, path, fmt, by, row_limit, ";", mode)


def partition_counts(written: DataFrame, by: str = "tb") -> DataFrame:
    """Rows per folder of a table that was written by territory and read back."""
    part = F.coalesce(F.col(by).cast("string"), F.lit("_"))
    return written.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("out_rows"))


def _mode(df: DataFrame, mode: str, by: str | None) -> DataFrameWriter:
    if mode != "replace":
        return df.write.mode(mode)
    if by is None:
        raise ValueError("only a table with a folder per value can be replaced in part")
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def write_slices(
    slices: DataFrame, manifest: DataFrame, path: str, split: bool = True, mode: str = "overwrite"
) -> None:
    """Dashboard data as JSON lines, one folder per slice (or one for all), and the manifest.

    The manifest is written last, so it never names a slice that is not there yet. In mode `replace`
    only the slices of this run are rewritten, and their lines of the manifest.
    """
    writer = _mode(json_safe(slices), mode, "slice_key" if split else None)
    if split:
        writer = writer.partitionBy("slice_key")
    writer.json(f"{path}/slices")
    lines = json_safe(manifest)
    if mode == "replace":
        known = manifest.sparkSession.read.schema(manifest.schema).json(f"{path}/manifest")
        others = known.join(manifest.select("slice_key"), "slice_key", "left_anti")
        # What is read here is overwritten below.
        lines = materialise(lines.unionByName(others))
    lines.write.mode("overwrite" if mode == "replace" else mode).json(f"{path}/manifest")


def read_slices(spark: SparkSession, path: str, schema: str | T.StructType, keys: Sequence[str] = ()) -> DataFrame:
    """Slices that `write_slices` has written and its manifest names; `keys` reads only their folders."""
    held = spark.read.schema(schema).json(f"{path}/slices")
    named = spark.read.schema("slice_key string").json(f"{path}/manifest")
    if keys:
        held = held.filter(F.col("slice_key").isin(list(keys)))
    return held.join(named, "slice_key", "left_semi")


def slice_manifest(records: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalogue of slices with the number of records in each."""
    counts = records.groupBy("slice_key").agg(F.count(F.lit(1)).alias("record_count"))
    return catalog.join(counts, "slice_key").select(*catalog.columns, "record_count")
