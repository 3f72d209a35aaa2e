"""Merkle manifest of a table: one leaf per row, a subroot per group, one root.

A leaf is the SHA-256 of its row's values. In each group leaves are ranked, and the rank's digits
in base ``FAN`` are grouped away one after the other: rows that differ in the last digit only
become one row with their structs nested as an array and their hash, and so on until a block of
``FAN ** DEPTH`` leaves is one row that holds a tree of structs. Blocks bound what a row may hold;
their hashes are the leaves of the next storey, of which there are log(rows) / log(block) ones. The
groups' subroots, ranked as well, are the leaves of one more such tree. Proofs come from the nested
structs by ``transform``, then the blocks are exploded: leaves are never joined. Only blocks,
one row per ``FAN ** DEPTH`` leaves, meet their own path by key.

Ranks come from a range partitioning by group, key and leaf and a sort inside: the place in the
partition, less where the group begins there, plus the group's rows in earlier partitions. No task
sees a whole group. Rows that are equal in all three have an arbitrary but stored order among
them, which no hash can tell.

Nulls hash as ``-``, other values as their UTF-8 length, a colon and their text. A null group is a
group, first in order; null keys come first in their group. A table without rows has no root.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.scalar import quoted
from riskflow.session import discard, materialize

# Nodes of a run, and digits of a rank that are grouped away within a block.
FAN, DEPTH = 16, 3
BLOCK = FAN**DEPTH

_NO_STEPS = "array<struct<place:int,siblings:array<string>>>"


def digest(parts: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of texts one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value as it goes into a leaf."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


def leaf(columns: Sequence[Column]) -> Column:
    return digest([field(column) for column in columns])


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(nodes: DataFrame) -> DataFrame:
    """``nodes`` (``group``, ``key``, ``hash``, ``row``) with ``rank``, from 0 in their group by key,
    in place of the key, and ``size``, the group's rows."""
    stored = materialize(nodes.withColumn("id", F.monotonically_increasing_id()), "leaves")
    partitions = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.asc_nulls_first(name) for name in ("group", "key", "hash", "id")]
    dealt = stored.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    # Partition number and place in it, pinned by the write.
    place = F.monotonically_increasing_id()
    placed = materialize(
        dealt.drop("id", "key").withColumn("part", F.shiftright(place, 33))
        .withColumn("place", place.bitwiseAND((1 << 33) - 1)),
        "placed",
    )
    discard(stored)
    # Of a group: a row for each partition it reaches into.
    pieces = placed.groupBy("part", "group").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("n")
    )
    pieces = pieces.selectExpr(
        "part", "group", "first",
        "coalesce(sum(n) OVER (PARTITION BY group ORDER BY part"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before",
        "sum(n) OVER (PARTITION BY group) AS size",
    ).withColumnsRenamed({"part": "p", "group": "g"})
    same = (F.col("part") == F.col("p")) & F.col("group").eqNullSafe(F.col("g"))
    rank = F.col("place") - F.col("first") + F.col("before")
    return placed.join(pieces, same).withColumn("rank", rank).drop(
        "p", "g", "part", "place", "first", "before"
    )


def _blocks(nodes: DataFrame) -> DataFrame:
    """Nodes (``group``, ``rank``, ``size``, ``hash``, ``row``) as one row per block: ``group``,
    ``block``, ``size``, ``hash`` and ``tree``, nested structs with a level per digit.

    A level hashes its runs unless the group has a single node left there. Dealt by block
    once; every grouping after that finds its rows together.
    """
    digits = [f"d{level}" for level in range(DEPTH)]
    rows = nodes.select(
        "group",
        F.floor(F.col("rank") / BLOCK).cast("long").alias("block"),
        *(F.shiftright("rank", 4 * level).bitwiseAND(FAN - 1).alias(d) for level, d in enumerate(digits)),
        "size", "hash", "row",
    ).repartition("group", "block")
    nested = ["row"]
    for level, digit in enumerate(digits):
        keys = ["group", "block", *digits[level + 1 :], "size"]
        # The digit first: structs sort by it.
        child = F.struct(digit, "hash", *nested)
        run = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(child)).alias("nodes"))
        hashes = F.transform("nodes", lambda node: node["hash"])
        several = F.col("size") > FAN**level
        rows = run.withColumn(
            "hash", F.when(several, digest([F.array_join(hashes, "")])).otherwise(F.element_at(hashes, 1))
        )
        nested = ["nodes"]
    return rows.withColumnRenamed("nodes", "tree")


def _step(nodes: Column, place: Column, several: Column) -> Column:
    """The step of a proof at one storey: an array of one struct, empty where nothing is hashed."""
    hashes = F.transform(nodes, lambda node: node["hash"])
    others = F.filter(hashes, lambda _, i: i != place)
    return F.when(several, F.array(F.struct(place.alias("place"), others.alias("siblings")))).otherwise(
        F.array().cast(_NO_STEPS)
    )


def _exploded(blocks: DataFrame, carried: str) -> DataFrame:
    """One row per node of the blocks: ``group``, ``hash``, the column that was ``carried``, its
    ``proof`` (that within the block, then the block's ``path``) and the block's ``tops``."""
    several = [F.col("size") > FAN**level for level in range(DEPTH)]

    def below(a: Column, i: Column) -> Column:
        return F.flatten(F.transform(a["nodes"], lambda b, j: lowest(a, i, b, j)))

    def lowest(a: Column, i: Column, b: Column, j: Column) -> Column:
        upper = F.concat(
            _step(a["nodes"], j, several[1]), _step(F.col("tree"), i, several[2]), F.col("path")
        )
        return F.transform(
            b["nodes"],
            lambda c, k: F.struct(
                c["hash"].alias("hash"),
                c[carried].alias(carried),
                F.concat(_step(b["nodes"], k, several[0]), upper).alias("proof"),
            ),
        )

    return blocks.select("group", "tops", F.inline(F.flatten(F.transform("tree", below))))


def _storeys(nodes: DataFrame) -> list[DataFrame]:
    """Blocks of the ranked nodes, then blocks of those, until each group has a single one."""
    storeys = []
    while True:
        blocks = materialize(_blocks(nodes), "blocks")
        storeys.append(blocks)
        if not blocks.agg(F.max("block")).first()[0]:
            return storeys
        nodes = blocks.select(
            "group", F.col("block").alias("rank"),
            F.ceil(F.col("size") / BLOCK).cast("long").alias("size"), "hash", F.col("block").alias("row"),
        )


def _proven(storeys: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The lowest storey's nodes with the ``tops`` of their group and the ``proof`` that ends in
    the ``path`` of those (``group``, ``path``, ``tops``)."""
    paths = tops.withColumn("row", F.lit(0).cast("long"))
    for storey in reversed(storeys):
        paths = paths.select(
            F.col("group").alias("g"), F.col("row").alias("b"), "path", "tops"
        )
        same = F.col("group").eqNullSafe(F.col("g")) & (F.col("block") == F.col("b"))
        nodes = _exploded(storey.join(paths, same).drop("g", "b"), "row")
        paths = nodes.withColumnRenamed("proof", "path")
    return nodes


def manifest(leaves: DataFrame) -> DataFrame:
    """``leaves`` (``group``, ``key``, ``hash`` and any other columns of orderable types) with
    ``subroot``, ``root`` and ``proof``, the steps from the leaf over its subroot to the root.

    A step has the node's ``place`` in its run and ``siblings``, the others' hashes, left to right.
    """
    others = [name for name in leaves.columns if name not in ("group", "key", "hash")]
    nodes = leaves.select(
        "group", "key", "hash", F.struct("key", *(F.col(quoted(name)) for name in others)).alias("row")
    )
    storeys = _storeys(ranked(nodes))
    # All subroots, in the order of their groups, are one more group.
    subroots = storeys[-1].select(
        F.lit(0).alias("group"), F.col("group").alias("key"), "hash",
        F.struct(F.col("group").alias("own"), "hash").alias("row"),
    )
    above = _storeys(ranked(subroots))
    none = F.array().cast(_NO_STEPS)
    root = above[-1].select("group", none.alias("path"), F.col("hash").alias("tops"))
    tops = _proven(above, root).select(
        F.col("row.own").alias("group"), F.col("proof").alias("path"),
        F.struct(F.col("row.hash").alias("subroot"), F.col("tops").alias("root")).alias("tops"),
    )
    proven = _proven(storeys, tops)
    of_row = {name: F.col("row").getField(name) for name in ("key", *others)}
    columns = (of_row.get(name, F.col(name)).alias(name) for name in leaves.columns)
    return proven.select(*columns, "tops.subroot", "tops.root", "proof")


def proof_digest(proof: Column) -> Column:
    """SHA-256 of all siblings, from the leaf up."""
    siblings = F.flatten(F.transform(proof, lambda step: step["siblings"]))
    return digest([F.array_join(siblings, "")])


def folded(hash_: Column, proof: Column) -> Column:
    """The root that a leaf's hash gives with its proof."""

    def up(below: Column, step: Column) -> Column:
        left = F.slice(step["siblings"], 1, step["place"])
        right = F.slice(step["siblings"], step["place"] + 1, F.lit(FAN))
        return digest([F.array_join(left, ""), below, F.array_join(right, "")])

    return F.aggregate(proof, hash_, up)
