"""Near duplicates by bottom-k sketches of one hash function.

1. Texts become sets of shingle hashes. Equal sets are one node, so copies cost one row each.
2. The k smallest hashes of a node are its sketch. Two sets of similarity t share at least ``floor``
   of the k smallest values of their union, but for a chance of MISS; values are ordered from rare
   to common, and of ``floor`` shared values at least SHARED lie among the first
   size - floor + SHARED of both. Only those are put into inverted lists.
3. Lists of up to SHORT_LIST nodes give pairs, and pairs of SHARED lists are candidates. Nodes of
   longer lists go to the next level with a larger k, where a common passage reaches less far into
   the rare values; at the last level most texts are there as whole sets. The first level is that
   large at once: with few values lists grow long as the table grows, and all nodes would be listed
   twice. What is common even at the last level are large groups of near copies: each node is
   compared with the nodes beside it in some orders of its group, and after those links only pairs of
   nodes that are in different components are left.
4. The union sketch (the k smallest values of both sketches) estimates the similarity of candidates.
5. What passes is verified on the full sets: at first the best two candidates of each node, then
   those pairs that are not yet connected. Components follow from verified links only.

No list, group or number of partners has a cap.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.llm import hashing
from dwellspark.llm.components import components
from dwellspark.llm.held import forget
from dwellspark.llm.tables import stored

#: Retained values at the levels of inverted lists; the last is sketched for the nodes that need it.
SKETCHES = (128, 512)
#: Retained values in the estimate of a candidate pair.
ESTIMATE = 64
#: Lists that two candidates have in common.
SHARED = 3
#: Chance that a pair at the threshold is not found by the lists of a level or by the estimate.
MISS = 1e-9
#: Nodes of a list that is paired at once.
SHORT_LIST = 32
#: Orders in which large groups are gone through, and nodes before a node that it is compared with.
ORDERS, REACH = 4, 24

#: The characters that separate words.
SEPARATOR = hashing.byte_set(0x20, range(0x09, 0x0E))
FOLD = hashing.fold_table()


def overlap_floor(k: int, percent: int) -> int:
    """Least number of the k smallest values of a union that both sets share, but for MISS."""
    p, total = percent / 100, 0.0
    for x in range(k + 1):
        total += math.comb(k, x) * p**x * (1 - p) ** (k - x)
        if total > MISS:
            return x
    return k


def shared_lists(percent: int) -> int:
    """Lists that a pair at the threshold has in common: SHARED, or fewer if small sets overlap less."""
    smallest = -(-percent // (100 - percent))
    return min(SHARED, -(-smallest * percent // 100))


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    for group in hashing.groups(column):
        values, bounds = hashing.shingles(hashing.words(group, SEPARATOR, FOLD), size)
        for i in range(len(bounds) - 1):
            yield np.unique(values[bounds[i] : bounds[i + 1]])


def _sketch(size: int, k: int):
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            n, nodes, kept = [], [], []
            for values in _sets(batch.column("text"), size):
                n.append(len(values))
                # One number for the whole set: sums over two mixings, mixed with the size.
                other = hashing.mix(values ^ hashing.MULTIPLIERS[9])
                sums = np.array([values.sum(dtype=np.uint64), other.sum(dtype=np.uint64), np.uint64(len(values))])
                nodes.append((sums * hashing.MULTIPLIERS[:3]).sum(dtype=np.uint64))
                # A copy: a slice would hold the whole set until the batch is done.
                kept.append(values[:k].copy())
            lengths = np.array([len(v) for v in kept], dtype=np.int32)
            flat = np.concatenate(kept) if kept else np.zeros(0, np.uint64)
            lists = pa.ListArray.from_arrays(
                np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), pa.array(flat.view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(n, pa.int64()), pa.array(hashing.mix(np.array(nodes, np.uint64)).view(np.int64)), lists],
                schema=schema,
            )

    return run


def similar_size(percent: int, a: str = "n_a", b: str = "n_b") -> Column:
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _postings(nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """``v, node, n, df, place``: the rarest retained values of each node that another node has too.

    ``place`` counts the node's values from the rarest on.
    """
    floor = overlap_floor(k, percent)
    values = nodes.select("node", "n", F.slice("sketch", 1, k).alias("s")).select(
        "node", "n", F.size("s").alias("size"), F.explode("s").alias("v")
    )
    common = values.groupBy("v").agg(F.count("*").alias("df")).filter(F.col("df") > 1)
    shared = values.join(common, "v")
    order = Window.partitionBy("node").orderBy("df", "v")
    least = F.least(F.lit(floor), F.ceil(F.col("n") * percent / 100))
    ranked = (
        shared.withColumn("r", F.row_number().over(order))
        .withColumn("alone", F.col("size") - F.count("*").over(Window.partitionBy("node")))
        .filter(F.col("alone") + F.col("r") <= F.col("size") - least + shared_lists(percent))
    )
    return ranked.select("v", "node", "n", "df", (F.col("alone") + F.col("r")).alias("place"))


def _pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes of similar size with SHARED lists in common; ``lists`` has v, node, n."""
    left = lists.select("v", F.col("node").alias("a"), F.col("n").alias("n_a"))
    right = lists.select("v", F.col("node").alias("b"), F.col("n").alias("n_b"))
    joined = left.join(right, "v").filter((F.col("a") < F.col("b")) & similar_size(percent))
    return joined.groupBy("a", "b").agg(F.count("*").alias("lists")).filter(F.col("lists") >= shared_lists(percent)).select("a", "b")


def _beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group: each node with the two most similar of the REACH nodes before it."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("estimate", pa.float64())])
    group, before = None, []
    for batch in batches:
        rounds, values, nodes = (batch.column(c).to_numpy() for c in ("round", "v", "node"))
        flat, at = batch.column("sketch").flatten().to_numpy(), batch.column("sketch").offsets.to_numpy()
        at = at - at[0]
        a, b, estimates = [], [], []
        for i in range(len(batch)):
            own = flat[at[i] : at[i + 1]]
            if (rounds[i], values[i]) != group:
                group, before = (rounds[i], values[i]), []
            if before:
                ends = np.cumsum([len(x) for _, x in before])
                inside = np.cumsum(np.isin(np.concatenate([x for _, x in before]), own))[ends - 1]
                common = np.diff(np.concatenate([[0], inside]))
                for j in np.argsort(-common, kind="stable")[:2]:
                    a.append(min(nodes[i], before[j][0]))
                    b.append(max(nodes[i], before[j][0]))
                    estimates.append(common[j] / (len(own) + len(before[j][1]) - common[j]))
            before = [*before[-REACH + 1 :], (nodes[i], own)]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(estimates, pa.float64())], schema=schema)


def _groups(nodes: DataFrame) -> DataFrame:
    """Likely pairs of large groups, ``a, b, estimate``. In each order nodes meet under the smallest
    of their values by another hash; sorted buckets split a hot group between tasks."""
    orders = nodes.select("node", "sketch", F.explode(F.sequence(F.lit(1), F.lit(ORDERS))).alias("round"))
    keyed = orders.select(
        "round",
        F.expr("array_min(transform(sketch, x -> struct(xxhash64(x, round) as h, x as v)))")["v"].alias("v"),
        F.xxhash64("node", "round").alias("place"),
        "node",
        F.slice("sketch", 1, ESTIMATE).alias("sketch"),
    )
    order = ["round", "v", "place"]
    found = keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_beside, "a long, b long, estimate double")
    return found.filter(F.col("a") != F.col("b")).groupBy("a", "b").agg(F.max("estimate").alias("estimate"))


def _estimate(percent: int):
    """Candidates whose union sketch allows the threshold, with the estimate."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("estimate", pa.float64())])
    floors: dict[int, int] = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = batch.column("s_a"), batch.column("n_a").to_numpy()
            right = batch.column("s_b"), batch.column("n_b").to_numpy()
            flat_a, flat_b = (c.flatten().to_numpy().view(np.uint64) for c in (left[0], right[0]))
            at_a, at_b = (c.offsets.to_numpy() - c.offsets[0].as_py() for c in (left[0], right[0]))
            out = np.full(len(batch), -1.0)
            for i in range(len(batch)):
                x, y = flat_a[at_a[i] : at_a[i + 1]], flat_b[at_b[i] : at_b[i + 1]]
                both = np.sort(np.concatenate([x, y]))
                twice = np.zeros(len(both), bool)
                twice[1:] = both[1:] == both[:-1]
                # Distinct values up to a place, and shared ones among them. A sketch shorter than k
                # is a whole set, so the union sketch reaches as far as the shorter full sketch does.
                k = min([len(s) for s, n in ((x, left[1][i]), (y, right[1][i])) if len(s) < n], default=len(both))
                distinct = np.cumsum(~twice)
                end = np.searchsorted(distinct, k, side="right")
                size, common = min(k, int(distinct[-1])), int(twice[:end].sum())
                if k == len(both):
                    good = common * 100 >= percent * size
                else:
                    if size not in floors:
                        floors[size] = overlap_floor(size, percent)
                    good = common >= floors[size]
                if good:
                    out[i] = common / size
            keep = out >= 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep)), pa.array(out[keep])],
                schema=schema,
            )

    return run


def _estimated(pairs: DataFrame, nodes: DataFrame, percent: int, k: int = ESTIMATE) -> DataFrame:
    sketch = F.slice("sketch", 1, k)
    left = nodes.select(F.col("node").alias("a"), F.col("n").alias("n_a"), sketch.alias("s_a"))
    right = nodes.select(F.col("node").alias("b"), F.col("n").alias("n_b"), sketch.alias("s_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").filter(similar_size(percent))
    return both.mapInArrow(_estimate(percent), "a long, b long, estimate double")


def _verify(size: int, percent: int):
    """Rows sorted by centre, the centre's own text first: links of members to their centre."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        centre, own = None, None
        for batch in batches:
            a, b = [], []
            columns = zip(batch.column("centre").to_pylist(), batch.column("node").to_pylist(), _sets(batch.column("text"), size), strict=True)
            for at, node, values in columns:
                if node == at:
                    centre, own = at, values
                    continue
                if centre != at:
                    raise ValueError("a member came without its centre")
                common = len(np.intersect1d(own, values, assume_unique=True))
                if 100 * common >= percent * (len(own) + len(values) - common):
                    a.append(at)
                    b.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    return run


def _verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs whose full sets reach the threshold. Each member goes to its centre a, once per pair."""
    members = pairs.select(F.col("a").alias("centre"), F.col("b").alias("node"))
    centres = pairs.select(F.col("a").alias("centre"), F.col("a").alias("node")).distinct()
    rows = members.unionByName(centres).join(texts, "node").select("centre", "node", "text")
    own = (F.col("node") != F.col("centre")).cast("int")
    ordered = rows.repartition("centre").withColumn("member", own).sortWithinPartitions("centre", "member")
    return ordered.select("centre", "node", "text").mapInArrow(_verify(size, percent), "a long, b long")


def _links(candidates: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Verified links that connect what all verified candidates would connect."""
    ends = candidates.select("a", "b", "estimate").unionByName(
        candidates.select(F.col("b").alias("a"), F.col("a").alias("b"), "estimate")
    )
    best = ends.groupBy("a").agg(
        F.max(F.struct("estimate", (-F.col("b")).alias("b"))).alias("best"), F.min("b").alias("least")
    )
    chosen = (
        best.select("a", F.explode(F.array(-F.col("best.b"), F.col("least"))).alias("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    first = stored(_verified(chosen, texts, size, percent))
    labels = stored(components(first))
    apart = _apart(candidates.select("a", "b").join(chosen, ["a", "b"], "left_anti"), labels)
    return first.unionByName(stored(_verified(apart, texts, size, percent)))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose nodes are in different components."""
    a = labels.select(F.col("node").alias("a"), F.col("component").alias("c_a"))
    b = labels.select(F.col("node").alias("b"), F.col("component").alias("c_b"))
    joined = pairs.join(a, "a", "left").join(b, "b", "left")
    return joined.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def near_duplicates(
    docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row.

    Words are runs of other than white space, A to Z in lower case. Two rows are linked when 100
    times the common shingles reach ``percent`` times the shingles of both; ``component_id`` is the
    smallest id reachable. A text with fewer words than a shingle is one shingle. A null, empty or
    blank text has no shingle and is linked with nothing, not even another of its kind: its component
    is itself. Repeated rows are equal sets. A null id keeps its row and never names a component
    (null if there is no other id); an empty table stays empty.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = stored(base.mapInArrow(_sketch(shingle, SKETCHES[0]), "id long, n long, node long, sketch array<long>"))
    sets = rows.filter(F.col("n") > 0)
    least = sets.groupBy("node").agg(F.min("id").alias("id"), F.min("n").alias("n"))
    # Smaller sets are similar to equal ones only.
    some = sets.filter(F.col("id").isNotNull() & (F.col("n") * (100 - percent) >= percent))
    nodes = stored(
        some.groupBy("node").agg(F.min(F.struct("id", "n", "sketch")).alias("one")).select("node", "one.id", "one.n", "one.sketch")
    )
    postings = stored(_postings(nodes, SKETCHES[0], percent))
    pairs = _pairs(postings.filter(F.col("df") <= SHORT_LIST), percent)
    # The last level makes its own sketches, so these stay where they are.
    hot = stored(postings.filter(F.col("df") > SHORT_LIST).select("node").distinct())
    near = stored(_estimated(pairs, nodes, percent))
    needed = near.select(F.explode(F.array("a", "b")).alias("node")).unionByName(hot).distinct()
    ids = needed.join(nodes.select("node", "id"), "node")
    texts = stored(base.join(ids, "id").select("node", "text").dropDuplicates(["node"]))
    large = stored(
        texts.join(hot, "node", "left_semi")
        .select(F.col("node").alias("id"), "text")
        .mapInArrow(_sketch(shingle, SKETCHES[-1]), "id long, n long, node long, sketch array<long>")
        .select(F.col("id").alias("node"), "n", "sketch")
    )
    lists = stored(_postings(large, SKETCHES[-1], percent))
    together = large.join(lists.select("node").distinct(), "node", "left_semi")
    candidates = near.unionByName(_groups(together)).groupBy("a", "b").agg(F.max("estimate").alias("estimate"))
    links = _links(stored(candidates), texts, shingle, percent)
    labels = stored(components(links))
    rest = _remaining(lists, labels, large, percent)
    if not rest.isEmpty():
        links = links.unionByName(_links(rest, texts, shingle, percent))
        labels = stored(components(links))
    least = least.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = least.groupBy("component").agg(F.min("id").alias("component_id"))
    known = least.join(named, "component").select("node", "component_id")
    out = rows.filter(F.col("n") > 0).select("id", "n", "node").join(known, "node").select("id", "n", "component_id")
    blank = rows.filter(F.col("n") == 0).select("id", "n", F.col("id").alias("component_id"))
    return out.unionByName(blank).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _first_common(lists: DataFrame, percent: int, k: int) -> DataFrame:
    """Pairs of nodes in different components, each from the first list that both are in.

    ``lists`` has v, node, n, df, place and the component c. After the first common value two whole
    sets can share no more than the rest of the shorter one, which has to be enough; so most pairs
    of a large list are no result of the join.
    """
    earlier = Window.partitionBy("node").orderBy("df", "v").rowsBetween(Window.unboundedPreceding, -1)
    rows = lists.withColumn("before", F.collect_list("v").over(earlier))
    a, b = (rows.select("v", *[F.col(c).alias(f"{c}_{x}") for c in ("node", "n", "place", "c", "before")]) for x in "ab")
    needed = F.ceil((F.col("n_a") + F.col("n_b")) * percent / (100 + percent))
    rest = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b")) + 1
    possible = (F.greatest("n_a", "n_b") > k) | (rest >= needed)
    apart = (F.col("node_a") < F.col("node_b")) & (F.col("c_a") != F.col("c_b")) & similar_size(percent)
    first = ~F.arrays_overlap("before_a", "before_b")
    return a.join(b, "v").filter(apart & possible & first).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))


def _remaining(lists: DataFrame, labels: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Candidates of the last level whose nodes are in different components."""
    marked = lists.join(labels, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    mixed = marked.groupBy("v").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter(F.col("lo") != F.col("hi"))
    open_lists = stored(marked.join(mixed.select("v"), "v", "left_semi"))
    pairs = _first_common(open_lists, percent, SKETCHES[-1])
    return stored(_estimated(pairs, nodes, percent, SKETCHES[-1]))
