"""Sources mixed to target weights by hash thresholds; DataFrame functions only.

Every document has a 60-bit hash. A source first gives all its documents as often as its target allows; the rest of the
budget goes to the documents below a threshold. Sums of sizes by source and hash bucket find the bucket where the budget
ends; only that bucket is split further, 12 bits at a time, so no documents are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lamina.session import written

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2
BITS, LEVELS = 12, 5


def size_of(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def position_of(doc_id: Column, text: Column) -> Column:
    """Where a document lies in 60 bits; equal for equal rows only (but for collisions)."""
    digest = F.md5(F.concat_ws("|", doc_id.cast("string"), F.md5(text)))
    return F.conv(F.substring(digest, 1, BITS * LEVELS // 4), 16, 10).cast("long")


def _key(source: Column) -> Column:
    # Joins by source must find NULL as well.
    return F.when(source.isNull(), "-").otherwise(F.concat(F.lit("+"), source))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, source_size, target) for (source, source_size), one row per source.

    Sources in code point order, NULL last, take the weights in turn and share `share` times all sizes. Those whose part
    would exceed `most` times their size get that; what they leave goes to the others by weight. With level L, a source gets
    min(most * size, weight * L); sources reach their bound in the order of size / weight, so L follows from running sums.
    The windows go over one narrow row for each source.
    """
    everything = Window.partitionBy()
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("bound", most * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("bound").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    budget = F.sum("source_size").over(everything) * share
    rows = rows.withColumn("budget", budget).withColumn("full", F.col("bound") <= F.col("weight") * ((F.col("budget") - before) / rest))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("bound"))).over(everything), F.lit(0))
    level = left / F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    target = F.when(F.col("full"), F.col("bound").cast("double")).otherwise(F.col("weight") * level)
    return rows.select("source", "source_size", target.alias("target"))


def thresholds(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, source_size, target, copies, edge, at_edge) for documents (key, size, position) and `wanted`'s sources.

    Documents below `edge`, and those at it if `at_edge`, are taken once more than `copies` times.
    """
    copies = F.when(F.col("target") >= 2 * F.col("source_size"), 2).when(F.col("target") >= F.col("source_size"), 1).otherwise(0)
    plan = written(
        wanted.select(_key(F.col("source")).alias("key"), "source_size", "target", copies.alias("copies")), "targets"
    )
    cells = plan.select("key", (F.col("target") - F.col("copies") * F.col("source_size")).alias("left"), F.lit(0).cast("long").alias("cell"))
    cells = cells.where("left > 0")
    by_cell = Window.partitionBy("key").orderBy("cell")
    for level in range(1, LEVELS + 1):
        shift = BITS * (LEVELS - level)
        inside = (
            docs.join(cells.withColumnRenamed("cell", "outer"), "key").where(F.shiftright("position", shift + BITS) == F.col("outer"))
            .groupBy("key", "left", F.shiftright("position", shift).alias("cell")).agg(F.sum("size").alias("size"))
        )
        before = F.coalesce(F.sum("size").over(by_cell.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        crossing = inside.withColumn("before", before).where("before < left and left <= before + size")
        cells = written(crossing.select("key", (F.col("left") - F.col("before")).alias("left"), "cell", "size"), "cells")
        if level < LEVELS:
            cells = cells.drop("size")
    edges = cells.select("key", F.col("cell").alias("edge"), (2 * F.col("left") >= F.col("size")).alias("at_edge"))
    return written(plan.join(edges, "key", "left"), "edges")


def _with_taken(rows: DataFrame, edges: DataFrame) -> DataFrame:
    more = (F.col("position") < F.col("edge")) | ((F.col("position") == F.col("edge")) & F.col("at_edge"))
    times = F.col("copies") + F.coalesce(more, F.lit(False)).cast("int")
    return rows.join(edges, "key").withColumn("taken", F.col("size") * times)


def _edges(docs: DataFrame, weights: tuple[int, ...], share: float, most: int) -> tuple[DataFrame, DataFrame]:
    narrow = written(
        docs.select("doc_id", "source", _key(F.col("source")).alias("key"), size_of(F.col("text")).alias("size"),
                    position_of(F.col("doc_id"), F.col("text")).alias("position")), "sizes",
    )
    by_source = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    return narrow, thresholds(narrow, targets(by_source, weights, share, most))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(doc_id, size, source_size, target, taken), one row per input row; taken is 0, 1 or 2 times the size.

    Each source's taken words differ from its target by at most half the size of the document at the threshold. Equal rows
    lie at the same place and are taken alike. A NULL text has size 0; a NULL source is a source of its own. `most` is at
    most 2. Other columns are not read; an empty table gives an empty one. Nothing is random, so reruns agree.
    """
    narrow, edges = _edges(docs, weights, share, most)
    return _with_taken(narrow, edges).select(F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The documents that the mix takes, with all columns and size, source_size, target, taken. Texts aren't shuffled.

    Columns of `docs` that have one of these names are replaced.
    """
    _, edges = _edges(docs, weights, share, most)
    own = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    rows = docs.select(own, _key(docs["source"]).alias("key"), size_of(docs["text"]).alias("size"), position_of(docs["doc_id"], docs["text"]).alias("position"))
    made = ("size", "source_size", "target", "taken")
    kept = [F.col("row")[c].alias(c) for c in docs.columns if c not in made]
    return _with_taken(rows, edges).where("taken > 0").select(*kept, *made)
