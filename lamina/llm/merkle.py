"""Merkle manifest of a dataset by cogrouped subtree exchange.

Every row is a leaf; the leaves of a language form a tree of fan-out 8, and the roots of the languages, in order, form the
tree above them. Superblocks of 4,096 leaves (four levels) are reduced first, each to one outer node; outer nodes are superblocks
of the next round, so that rounds are few at any size. On the way down the leaves of a superblock are cogrouped with the outer
nodes that their proofs need, one row of siblings per superblock; local reduction, proof and folding happen there together.
"""

from __future__ import annotations

import string
from collections.abc import Callable
from hashlib import sha256

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import written

FAN = 8
# Levels of a superblock, so that it has 4,096 leaves.
LEVELS = 4
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Rows whose number's CRC-32 this divides are tampered with.
TAMPER_STEP = 3
_SIBLINGS = "array<struct<left: string, right: string>>"
_SCHEMA = (
    "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
    "lang string, position long, n_levels int"
)
# The row of a partition in the number that Spark gives it.
_ROW_BITS = 33


def _hash(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    """SHA-256 of the fields in their fixed order, each with its length in bytes, `-` for NULL."""
    return F.sha2(F.concat(*[_field(columns[c]) for c in LEAF_COLUMNS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, lang, doc_id, leaf, given): `given` is the leaf as somebody else claims it to be, after tampering."""
    own = {c: F.col(c) for c in LEAF_COLUMNS}
    own["doc_id"] = own["doc_id"].cast("long")
    lowered = F.translate(F.col("text"), string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.crc32(own["doc_id"].cast("string")) % TAMPER_STEP == 0
    given = F.when(tampered, leaf_hash({**own, "text": lowered})).otherwise(F.col("leaf"))
    # Sorts like the language, with NULL first.
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit("-"))
    rows = docs.select(*LEAF_COLUMNS).withColumn("leaf", leaf_hash(own)).withColumn("given", given)
    return rows.select(tree.alias("tree"), "lang", own["doc_id"].alias("doc_id"), "leaf", "given")


def placed(rows: DataFrame, order: list[str], levels: int) -> DataFrame:
    """`rows` with `position` in their tree from 0, `n` rows of the tree, and `block`; equal rows are placed in any order.

    Rows are range partitioned by (tree, order, own number), so that a large tree and a row with many copies are spread over all
    tasks. A position is the row's place in its partition behind the rows of its tree in the partitions before.
    """
    named = written(rows.withColumn("_own", F.monotonically_increasing_id()), "leaves")
    keys = [F.col(c).asc_nulls_first() for c in ("tree", *order, "_own")]
    sorted_rows = written(
        named.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _ROW_BITS)).drop("_own"),
        "placed",
    )
    spans = sorted_rows.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy("tree")
    before = F.sum("_rows").over(whole.orderBy("_part")) - F.col("_rows")
    spans = spans.withColumn("_before", before).withColumn("n", F.sum("_rows").over(whole))
    position = F.col("_before") + F.col("_at") - F.col("_first")
    joined = sorted_rows.join(spans.drop("_rows"), ["tree", "_part"]).withColumn("position", position)
    return joined.withColumn("block", _block_of("position", levels)).drop("_part", "_at", "_first", "_before")


def _block_of(position: str, levels: int) -> Column:
    return F.expr(f"{position} div {FAN**levels}")


def height(n: int, most: int) -> int:
    """Levels a superblock of a tree with n nodes is reduced by: to one node, or by the most where the tree goes on."""
    levels = 0
    while levels < most and FAN**levels < n:
        levels += 1
    return levels


def reduced(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of each level, the given ones first."""
    out = [digests]
    for _ in range(levels):
        last = out[-1]
        out.append([_hash("".join(last[i : i + FAN])) for i in range(0, len(last), FAN)])
    return out


def siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """Of each level but the last: the digests left and right of the node above or at place `at`, within its run."""
    out = []
    for nodes in levels[:-1]:
        start = at - at % FAN
        out.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + FAN])))
        at //= FAN
    return out


def folded(leaf: str, path: list[tuple[str, str]]) -> str:
    for left, right in path:
        leaf = _hash(left + leaf + right)
    return leaf


def _topped(most: int) -> Callable[[pa.Table], pa.Table]:
    """The outer node of a superblock."""

    def top(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        n, block = table.column("n")[0].as_py(), table.column("block")[0].as_py()
        node = reduced(table.column("leaf").to_pylist(), height(n, most))[-1][0]
        blocks = pa.array([-(-n // FAN**most)], pa.int64())
        return pa.table({"tree": table.column("tree")[:1], "position": pa.array([block], pa.int64()), "n": blocks, "leaf": pa.array([node])})

    return top


def raised(nodes: DataFrame, levels: int) -> list[tuple[DataFrame, DataFrame]]:
    """Rounds of (nodes, tops): the nodes of the trees that go on, and the roots of the trees that end in the round."""
    rounds = []
    while True:
        inner = nodes.select("tree", "block", "position", "n", "leaf")
        above = written(inner.groupBy("tree", "block").applyInArrow(_topped(levels), "tree string, position long, n long, leaf string"), "nodes")
        rounds.append((nodes, above.where("n = 1").select("tree", "leaf")))
        nodes = above.where("n > 1").withColumn("block", _block_of("position", levels))
        if nodes.isEmpty():
            return rounds


def _path(outer: pd.DataFrame) -> list[tuple[str, str]]:
    return [(s["left"], s["right"]) for s in outer["path"].iloc[0]]


def _inner_paths(most: int, names: str) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The siblings of every node of a superblock up to the last root; `names` is the column that holds the node's own name."""

    def paths(nodes: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("position")
        levels = reduced(nodes["leaf"].tolist(), height(int(nodes["n"].iloc[0]), most))
        up = _path(outer)
        found = [[{"left": a, "right": b} for a, b in siblings(levels, i) + up] for i in range(len(nodes))]
        return pd.DataFrame({"tree": nodes["tree"], "name": nodes[names], "path": found, "subroot": outer["subroot"].iloc[0]})

    return paths


def _outer_nodes(rounds: list[tuple[DataFrame, DataFrame]], last: DataFrame, levels: int) -> DataFrame:
    """(tree, block, path, subroot) for the superblocks of the first round; `last` is (tree, path) above the roots of the trees."""
    below = None
    for i in range(len(rounds) - 1, -1, -1):
        nodes, tops = rounds[i]
        outer = tops.join(last, "tree").select("tree", F.lit(0).cast("long").alias("block"), "path", F.col("leaf").alias("subroot"))
        if below is not None:
            outer = outer.unionByName(below)
        if i == 0:
            return outer
        inner = nodes.select("tree", "block", "position", "n", "leaf")
        below = written(
            inner.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block"))
            .applyInPandas(_inner_paths(levels, "position"), f"tree string, name long, path {_SIBLINGS}, subroot string"),
            "outer",
        ).withColumnRenamed("name", "block")


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, lang, position, n_levels): one row per input row.

    `position` is the leaf's place in the list of its language, `n_levels` the length of its proof. Languages are ordered bytewise,
    NULL first; leaves by doc_id, NULL first, those of one doc_id by their hash, and copies of a row in any order: they get proofs of
    different places. NULL fields count as `-`, an empty text as `0:`. Texts are hashed whole. Other columns are not read; an empty
    table gives an empty one.
    """
    spark = docs.sparkSession
    rows = written(placed(leaves(docs), ["doc_id", "leaf"], levels), "manifest")
    rounds = raised(rows, levels)
    tops = rounds[0][1]
    for _, more in rounds[1:]:
        tops = tops.unionByName(more)
    lists = placed(tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "leaf"), ["name"], levels)
    lists = written(lists, "lists")
    above = raised(lists, levels)
    found = above[-1][1].first()
    if found is None:
        return spark.createDataFrame([], _SCHEMA)
    root = found["leaf"]
    none = spark.createDataFrame([("", [])], f"tree string, path {_SIBLINGS}")
    # The paths of the languages are those of the leaves of the tree above them.
    inner = lists.select("tree", "block", "position", "n", "leaf", "name")
    paths = written(
        inner.groupBy("tree", "block").cogroup(_outer_nodes(above, none, levels).groupBy("tree", "block"))
        .applyInPandas(_inner_paths(levels, "name"), f"tree string, name string, path {_SIBLINGS}, subroot string"),
        "paths",
    ).select(F.col("name").alias("tree"), "path")
    outer = _outer_nodes(rounds, paths, levels)

    def proofs(block: pd.DataFrame, required: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position")
        nodes = reduced(block["leaf"].tolist(), height(int(block["n"].iloc[0]), levels))
        up, out = _path(required), []
        for i, given in enumerate(block["given"]):
            path = siblings(nodes, i) + up
            out.append((_hash("".join(a + b for a, b in path)), folded(given, path), len(path)))
        proof, ends, n = zip(*out)
        return pd.DataFrame({
            "doc_id": block["doc_id"], "leaf": block["leaf"], "subroot": required["subroot"].iloc[0], "root": root, "proof_sha256": list(proof),
            "folded_root": list(ends), "verified": [e == root for e in ends], "lang": block["lang"], "position": block["position"], "n_levels": list(n),
        })

    return rows.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(proofs, _SCHEMA)
