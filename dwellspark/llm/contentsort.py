"""Exact duplicates by a sort of the contents, with DataFrame functions only.

1. Every row gets a place in one order: the first bytes of its normalised text, then the digest of
   the text, then the identifier. Rows of a sample of that order, every so many of it, are the
   splitters, and a binary search over them names the bucket of a row. Identifiers are part of the
   order, so a text with a third of all rows is dealt over many buckets, as is a common beginning.
2. Each bucket is sorted (externally, by Spark), and each text is compared in full with the one
   before it. Runs of equal neighbours are groups.
3. A group can go on in the next bucket only as the first or last run of one. Those runs, two a
   bucket at most, are brought together by their full texts.

The texts are exchanged once. What follows the comparison holds one text per edge of a bucket.
"""

from __future__ import annotations

from collections.abc import Callable
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.llm.tables import stored, whole_text

#: Bytes of the text at the head of the order; what they share is told apart by digest.
HEAD_BYTES = 24
#: Bytes of text in a bucket, and buckets of a shuffle partition at least, so that partitions even out.
BUCKET_BYTES, BUCKETS_OF_PARTITION = 512 << 20, 4
#: Sampled rows for each splitter.
SAMPLED = 16


def content_order(docs: DataFrame, keep: str) -> DataFrame:
    """``docs`` (id, text) with ``sha`` and ``place``, whose string order is the order of the sort.

    In it the row to keep is the last of its text: ids count as unsigned numbers that grow towards the
    kept end, rows without an id come first, and equal ids are told apart by where they were read.
    """
    number = F.col("id").bitwiseXOR(F.lit(-(1 << 63)))
    if keep == "smallest":
        number = F.bitwise_not(number)
    elif keep != "largest":
        raise ValueError(f"keep is 'largest' or 'smallest', not {keep!r}")
    head = F.hex(F.substring(F.col("text").cast("binary"), 1, HEAD_BYTES))
    return docs.withColumn("sha", F.sha2("text", 256)).withColumn(
        "place",
        F.concat(
            F.rpad(head, 2 * HEAD_BYTES, " "),
            "sha",
            F.rpad(F.coalesce(F.lpad(F.hex(number), 16, "0"), F.lit("")), 16, " "),
            F.lpad(F.hex(F.spark_partition_id().cast("long")), 8, "0"),
        ),
    )


def splitters(placed: DataFrame, rows: int, buckets: int) -> list[str]:
    """Places that cut the rows into about ``buckets`` equal parts.

    Rows are sampled by a hash of their place, sorted by Spark, and every SAMPLED-th of a partition is
    taken, so the driver gets no more than the splitters. A splitter is cut off where it is told apart
    from the one before.
    """
    every = max(rows // (buckets * SAMPLED), 1)
    some = placed.select("place").filter(F.pmod(F.xxhash64("place"), F.lit(every)) == 0)
    ordered = some.repartitionByRange("place").sortWithinPartitions("place")
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    chosen = ordered.withColumn("inside", inside).filter(F.col("inside") % SAMPLED == SAMPLED // 2).select("place")
    out, before = [], ""
    for place in sorted({r["place"] for r in chosen.collect()}):
        out.append(place[: len(commonprefix([before, place])) + 1])
        before = place
    return out


def bucket_of(place: Column, cuts: list[str]) -> Column:
    """How many of the sorted ``cuts`` are no greater than ``place``, by binary search."""
    if not cuts:
        return F.lit(0)
    held = F.split(F.lit(",".join(cuts)), ",")
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]

    def advance(low: Column, step: Column) -> Column:
        ahead = low + step
        return F.when((ahead <= len(cuts)) & (F.get(held, ahead - 1) <= place), ahead).otherwise(low)

    return F.reduce(F.array(*map(F.lit, steps)), F.lit(0), advance)


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "largest",
    normalise: Callable[[Column], Column] | None = None,
    with_rows: bool = False,
) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` of every row; ``row`` with all its columns on demand.

    Texts are equal when they are identical after ``normalise`` (default: no change); a null text is an
    empty one, before and after. Of equal texts one row stays: that with the largest (or smallest) id;
    of rows that repeat that id any one, and a row without an id only if no other has one (``keep_id``
    is null then). An empty table stays empty. Other columns are read only ``with_rows``.
    """
    text = whole_text(F.col(f"`{text_col}`"))
    if normalise is not None:
        text = whole_text(normalise(text))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if with_rows else []
    own = [c for c in ("row",) if with_rows]
    base = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), *row)
    placed = content_order(base, keep)

    size = base.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(BUCKETS_OF_PARTITION * parts, (size["bytes"] or 0) // BUCKET_BYTES)
    cuts = splitters(placed, size["rows"], buckets)

    dealt = placed.withColumn("bucket", bucket_of(F.col("place"), cuts))
    order = Window.partitionBy("bucket").orderBy("place", "text")
    compared = dealt.select(
        "bucket",
        "id",
        "sha",
        "text",
        F.lag("text").over(order).alias("before"),
        F.lead(F.lit(True)).over(order).isNull().alias("ends"),
        F.row_number().over(order).alias("at"),
        *own,
    ).select(
        "bucket",
        "id",
        "sha",
        "at",
        (~F.col("text").eqNullSafe(F.col("before"))).alias("opens"),
        F.when(F.col("before").isNull() | F.col("ends"), F.col("text")).alias("edge"),
        *own,
    )
    line = Window.partitionBy("bucket").orderBy("at")
    numbered = compared.withColumn("run", F.sum(F.col("opens").cast("long")).over(line)).withColumn(
        "last", F.coalesce(F.lead("opens").over(line), F.lit(True))
    )
    run = Window.partitionBy("bucket", "run")
    best = F.max if keep == "largest" else F.min
    runs = stored(
        numbered.select(
            "bucket", "run", "id", "sha", "at", "last", "edge",
            best("id").over(run).alias("keep"), F.count("*").over(run).alias("size"), *own,
        )
    )

    # A bucket of one run has two edges of it: its last row is no edge of its own then.
    edges = runs.filter(F.col("edge").isNotNull() & ((F.col("at") == 1) | (F.col("run") > 1)))
    same = Window.partitionBy("sha", "edge")
    met = edges.select(
        "bucket",
        "run",
        best("keep").over(same).alias("all_keep"),
        F.sum("size").over(same).alias("all_size"),
        F.max("bucket").over(same).alias("all_last"),
    )
    joined = runs.join(met, ["bucket", "run"], "left")
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("all_size").isNull(), F.col("keep")).otherwise(F.col("all_keep")).alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        (F.col("last") & (F.col("bucket") == F.coalesce("all_last", "bucket"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *own,
    )


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The rows that stay, with the columns of ``docs``."""
    return exact_duplicates(docs, with_rows=True, **options).filter("kept").select("row.*")
