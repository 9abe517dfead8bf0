"""Reading tables, cutting lineage in the shared folder, and small column helpers of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwellspark.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, so that a lost executor costs no rerun."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def whole_text(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def id_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets
