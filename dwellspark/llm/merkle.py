"""Merkle manifest of a dataset as a persistent tree with path copying.

Rows are leaves, ordered by id inside their part of the dataset; every FAN consecutive nodes have one
parent. Parts of any size are worked on in aligned blocks of FAN ** BLOCK_LEVELS leaves: a block is a
small tree of its own whose top is a leaf of the next round of blocks. Rounds go on until one node of
each part is left, and the tops of the parts are leaves of one more such tree, whose top is the root.

A tampered leaf makes a version of its block: only the leaf and its ancestors are copied, every other
node is shared with the untampered tree. The version goes on above the block with the path that the
block itself has in the upper rounds, which is worked out once per block on the way down.

Spark places the leaves (range partitions, counts of partitions), deals the blocks to tasks and joins
each block to its upper path; no block has more than FAN ** BLOCK_LEVELS rows, however large its part.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dwellspark.llm.tables import id_bucket, stored

#: Children of a node, and levels of a block.
FAN, BLOCK_LEVELS = 8, 3
#: Columns of a row that its leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Every so many-th row, by a hash of its id, is tampered with.
TAMPERED = 3


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode("utf-8")).hexdigest()


@dataclass(frozen=True)
class Tree:
    """Levels of digests from the leaves up; never changed after it is built."""

    levels: tuple[tuple[str, ...], ...]

    @classmethod
    def build(cls, leaves: list[str], height: int) -> Tree:
        levels = [tuple(leaves)]
        for _ in range(height):
            below = levels[-1]
            levels.append(tuple(digest(*below[i : i + FAN]) for i in range(0, len(below), FAN)))
        return cls(tuple(levels))

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def around(self, place: int) -> list[tuple[str, str]]:
        """What is left and right of the path from a leaf, level by level, below the top."""
        out = []
        for level in self.levels[:-1]:
            run = place - place % FAN
            out.append(("".join(level[run:place]), "".join(level[place + 1 : run + FAN])))
            place //= FAN
        return out

    def version(self, place: int, leaf: str) -> Version:
        copied = [leaf]
        for left, right in self.around(place):
            copied.append(digest(left, copied[-1], right))
        return Version(self, place, tuple(copied))


@dataclass(frozen=True)
class Version:
    """A tree with another leaf: its copied path, and the rest of ``base``."""

    base: Tree
    place: int
    copied: tuple[str, ...]

    @property
    def top(self) -> str:
        return self.copied[-1]

    def node(self, level: int, place: int) -> str:
        return self.copied[level] if place == self.place // FAN**level else self.base.levels[level][place]


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def lowered(text: Column) -> Column:
    """A to Z in lower case, everything else as it is."""
    letters = "".join(map(chr, range(65, 91)))
    return F.translate(text, letters, letters.lower())


def _depth(total: Column) -> Column:
    """Levels above ``total`` leaves: octal digits of the last place, none for a lone leaf."""
    return F.when(total <= 1, 0).otherwise(F.length(F.conv((total - 1).cast("string"), 10, FAN)))


def _placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` with ``pos`` (from 0 in its part ``g``, by ``order``) and ``depth`` of the part."""
    keys = ["g", *order]
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    sorted_ = leaves.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = stored(sorted_.withColumn("slice", F.spark_partition_id()).withColumn("inside", inside))
    counts = kept.groupBy("g", "slice").agg(F.min("inside").alias("first"), F.count("*").alias("n"))
    part = Window.partitionBy("g")
    earlier = part.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "g",
        "slice",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
        _depth(F.sum("n").over(part)).alias("depth"),
    )
    joined = kept.join(starts, ["g", "slice"])
    return joined.withColumn("pos", F.col("inside") + F.col("shift")).drop("slice", "inside", "shift")


def _top(base: int, levels: int):
    """Block of nodes of level ``base`` to its top."""
    schema = pa.schema([("g", pa.string()), ("pos", pa.int64()), ("depth", pa.int32()), ("digest", pa.string())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        depth, pos = table["depth"][0].as_py(), table["pos"][0].as_py()
        tree = Tree.build(table["digest"].to_pylist(), min(levels, depth - base))
        return pa.Table.from_pylist(
            [{"g": table["g"][0].as_py(), "pos": pos // FAN**levels, "depth": depth, "digest": tree.top}], schema=schema
        )

    return run


def _rounds(nodes: DataFrame, deepest: int, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes of every round of blocks, and the top of each part (``g, digest``)."""
    rounds, tops = [], None
    for base in range(0, max(deepest, 1), levels):
        nodes = nodes.withColumn("block", F.floor(F.col("pos") / FAN**levels))
        rounds.append(nodes)
        grouped = nodes.select("g", "block", "pos", "depth", "digest").groupBy("g", "block")
        above = stored(grouped.applyInArrow(_top(base, levels), "g string, pos long, depth int, digest string"))
        done = above.filter(F.col("depth") <= base + levels).select("g", "digest")
        tops = done if tops is None else tops.unionByName(done)
        nodes = above.filter(F.col("depth") > base + levels)
    return rounds, tops


#: The path of a block: what is left and right of it on each level up to the root, and two tops.
PATH = pa.schema(
    [("g", pa.string()), ("pos", pa.int64()), ("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string())),
     ("subroot", pa.string()), ("root", pa.string())]
)
PATH_DDL = "g string, pos long, lefts array<string>, rights array<string>, subroot string, root string"
PROOFS = pa.schema(
    [("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof", pa.string()),
     ("folded", pa.string()), ("version", pa.list_(pa.string()))]
)
PROOFS_DDL = "id long, leaf string, subroot string, root string, proof string, folded string, version array<string>"


def _block(nodes: pa.Table, upper: pa.Table, base: int, levels: int) -> tuple[pa.Table, Tree, list[str], list[str], str, str]:
    nodes = nodes.sort_by("pos")
    tree = Tree.build(nodes["digest"].to_pylist(), min(levels, nodes["depth"][0].as_py() - base))
    path = upper.to_pylist()[0]
    return nodes, tree, path["lefts"], path["rights"], path["subroot"], path["root"]


def _inner_paths(base: int, levels: int):
    """Paths of the nodes of a block, from the path of the block."""

    def run(nodes: pa.Table, upper: pa.Table) -> pa.Table:
        nodes, tree, lefts, rights, subroot, root = _block(nodes, upper, base, levels)
        rows = []
        for i, (g, pos) in enumerate(zip(nodes["g"].to_pylist(), nodes["pos"].to_pylist(), strict=True)):
            own = tree.around(i)
            rows.append(
                {"g": g, "pos": pos, "lefts": [x for x, _ in own] + lefts, "rights": [y for _, y in own] + rights,
                 "subroot": subroot or tree.top, "root": root or tree.top}
            )
        return pa.Table.from_pylist(rows, schema=PATH)

    return run


def _proofs(base: int, levels: int):
    """Proof and folded root of every leaf of a block."""

    def run(nodes: pa.Table, upper: pa.Table) -> pa.Table:
        nodes, tree, lefts, rights, subroot, root = _block(nodes, upper, base, levels)
        above = list(zip(lefts, rights, strict=True))
        higher = "".join(x + y for x, y in above)
        rows = []
        columns = (nodes[c].to_pylist() for c in ("id", "digest", "altered"))
        for i, (doc_id, own, altered) in enumerate(zip(*columns, strict=True)):
            version = tree.version(i, own if altered is None else altered)
            copied = list(version.copied)
            for left, right in above:
                copied.append(digest(left, copied[-1], right))
            proof = digest("".join(x + y for x, y in tree.around(i)), higher)
            rows.append(
                {"id": doc_id, "leaf": own, "subroot": subroot, "root": root, "proof": proof, "folded": copied[-1],
                 "version": None if altered is None else copied}
            )
        return pa.Table.from_pylist(rows, schema=PROOFS)

    return run


def _descend(rounds: list[DataFrame], tops: DataFrame, levels: int, last, ddl: str) -> DataFrame:
    """Goes down from the tops of the parts (rows of PATH without pos) to the nodes of the first round."""
    below = None
    for level in reversed(range(len(rounds))):
        nodes, base = rounds[level], level * levels
        if level == 0:
            ends_here = F.col("depth") <= levels
        else:
            ends_here = (F.col("depth") > base) & (F.col("depth") <= base + levels)
        ends = nodes.filter(ends_here & (F.col("pos") == 0)).select("g")
        paths = tops.join(ends, "g").withColumn("block", F.lit(0).cast("long"))
        if below is not None:
            paths = paths.unionByName(below.withColumnRenamed("pos", "block"))
        paths = paths.select("g", "block", "lefts", "rights", "subroot", "root")
        pairs = nodes.groupBy("g", "block").cogroup(paths.groupBy("g", "block"))
        if level == 0:
            return pairs.applyInArrow(last(base, levels), ddl)
        below = stored(pairs.applyInArrow(_inner_paths(base, levels), PATH_DDL))
    raise AssertionError("a tree has a round at least")


def prove(leaves: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """Proofs of ``leaves``: ``part`` (its order is the order of the parts, null first), ``id``,
    ``digest`` and ``altered``, the digest of a tampered leaf or null. Columns are those of PROOFS."""
    named = leaves.withColumn("g", F.coalesce(F.concat(F.lit("v"), "part"), F.lit("n"))).drop("part")
    nodes = stored(_placed(named, ["id", "digest"]))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    rounds, subroots = _rounds(nodes, deepest, levels)
    # The tops of the parts are the leaves of the tree above them; parts are its ids.
    parts = subroots.select(F.col("g").alias("part"), F.lit("").alias("g"), "digest")
    upper = stored(_placed(parts, ["part"]))
    top_rounds, _ = _rounds(upper, upper.agg(F.max("depth")).first()[0] or 0, levels)
    empty = F.array().cast("array<string>")
    none = F.lit(None).cast("string")
    crown = upper.sparkSession.range(1).select(
        F.lit("").alias("g"), empty.alias("lefts"), empty.alias("rights"), none.alias("subroot"), none.alias("root")
    )
    by_place = stored(_descend(top_rounds, crown, levels, _inner_paths, PATH_DDL))
    known = upper.select("part", "pos", F.col("digest").alias("subroot"))
    tops = by_place.select("pos", "lefts", "rights", "root").join(known, "pos")
    return _descend(rounds, stored(tops.withColumnRenamed("part", "g").drop("pos")), levels, _proofs, PROOFS_DDL)


def manifest(docs: DataFrame, with_versions: bool = False, levels: int = BLOCK_LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row.

    A leaf covers the columns of FIELDS; null values count as ``-`` and a missing id also has a place,
    before all others. Parts are languages. Equal ids of a part are ordered by their leaves, and
    repeated rows are leaves of their own. Rows whose id (null: an empty text) has a crc32 divisible by
    TAMPERED have their text in lower case when their root is recomputed; the others are recomputed from
    what they are. An empty table has no rows and no root. Other columns are not read.
    ``with_versions`` adds ``version``: the copied nodes of a tampered row, from leaf to root, or null.
    """
    ids = docs.select(
        F.col("lang").alias("part"),
        F.col("doc_id").cast("long").alias("id"),
        *[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(FIELDS)],
    )
    fields = [F.col(f"f{i}") for i in range(len(FIELDS))]
    altered = [lowered(f) if name == "text" else f for f, name in zip(fields, FIELDS, strict=True)]
    leaves = ids.select(
        "part",
        "id",
        leaf(fields).alias("digest"),
        F.when(id_bucket(F.col("id"), TAMPERED) == 0, leaf(altered)).alias("altered"),
    )
    found = prove(leaves, levels)
    return found.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        F.col("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
        *(["version"] if with_versions else []),
    )
