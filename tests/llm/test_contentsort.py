import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dwellspark.llm import contentsort

SCHEMA = "doc_id long, text string, keep_id string, row int, bucket string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "k", 1, "b") for i, t in rows], SCHEMA).repartition(parts)


def brute(rows, keep=max):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best, stays = keep(known) if known else None, False
        for i in ids:
            kept = i == best and not stays
            stays = stays or kept
            out.append((i, best, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


def hostile():
    rng = random.Random(5)
    texts = ["", None, "a", "a\0", "a ", "A", "é", "é", "x" * 100_000, "x" * 99_999 + "y", "begin " * 20]
    rows = [(i, rng.choice(texts)) for i in range(300)]
    # A third of all rows has one text, and many texts share a long beginning.
    rows += [(1000 + i, "hot") for i in range(250)] + [(2000 + i, "begin " * 20 + str(i % 40)) for i in range(150)]
    rows += [(None, "hot"), (None, "only"), (None, "only"), (-7, "a"), (-(1 << 63), "b"), ((1 << 63) - 1, "b")]
    return rows + [(1000, "hot")] * 30 + [(1249, "hot")] * 3


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_against_brute_force(spark, keep):
    rows = hostile()
    got = found(contentsort.exact_duplicates(frame(spark, rows), keep=keep))
    assert got == brute(rows, max if keep == "largest" else min)


def test_normalised_texts_and_whole_rows(spark):
    rows = [(1, "Ab"), (2, "aB"), (3, None), (4, ""), (5, "c")]
    kept = contentsort.deduplicated(frame(spark, rows), normalise=F.lower)
    assert kept.columns == ["doc_id", "text", "keep_id", "row", "bucket"]
    assert sorted(tuple(r)[:2] for r in kept.collect()) == [(2, "aB"), (4, ""), (5, "c")]
    dropped = contentsort.exact_duplicates(frame(spark, rows), normalise=lambda t: F.nullif(t, F.lit("c")))
    assert {r["doc_id"]: r["group_size"] for r in dropped.collect()} == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3}


def test_empty_table_and_wrong_option(spark):
    assert contentsort.exact_duplicates(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        contentsort.exact_duplicates(frame(spark, []), keep="first")


def test_buckets_split_a_hot_text(spark):
    rows = hostile()
    placed = contentsort.content_order(frame(spark, rows).select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text")), "largest")
    cuts = contentsort.splitters(placed, len(rows), 16)
    assert 8 <= len(cuts) <= 64 and cuts == sorted(set(cuts))
    buckets = placed.select("text", "place", contentsort.bucket_of(F.col("place"), cuts).alias("bucket")).collect()
    assert all(r["bucket"] == sum(c <= r["place"] for c in cuts) for r in buckets)
    assert len({r["bucket"] for r in buckets if r["text"] == "hot"}) > 2


def test_plan_has_no_python(spark):
    df = contentsort.exact_duplicates(frame(spark, hostile()))
    assert "Python" not in df._jdf.queryExecution().toString() and "Arrow" not in df._jdf.queryExecution().toString()
