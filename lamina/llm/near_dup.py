"""Near duplicates by DartMinHash signatures and exact weighted Jaccard similarity.

Every shingle of five words is an element whose weight is its number of occurrences. A fixed random field of darts lies
over (element, weight, rank); a text sees the darts below the weights of its elements and below a rank limit that leaves
about `k ln k + 2k` of them. Each dart belongs to one of k coordinates, and the earliest dart of a coordinate is its value.
Two texts agree in a coordinate with the probability of their weighted Jaccard similarity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lamina.llm.graph import components
from lamina.llm.words import chunks, list_column, mixed, shingles, words_of
from lamina.session import written

SIMILARITY, SHINGLE = 0.8, 5
BANDS, ROWS = 32, 5
_ELEMENT = np.uint64(2**48 - 1)
# Darts in a unit cell are Poisson with mean 1.
_CDF = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(13)])
_DARTS = np.arange(1, 13, dtype=np.uint64) * np.uint64(0xE7037ED1A0B428DB)
_CELLS = 1_000_000
# Texts of a block: all those of a pivot, and those that aren't linked to it.
_BLOCK, _LOOSE = 1024, 256


def weighted_elements(doc: np.ndarray, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, element, occurrence) sorted by text; occurrences of an element in a text are counted from 0."""
    key = np.sort((doc.astype(np.uint64) << np.uint64(48)) | (shingle & _ELEMENT))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.arange(len(key))
    nth = at - np.maximum.accumulate(np.where(new, at, 0))
    return (key >> np.uint64(48)).astype(np.int64), key & _ELEMENT, nth.astype(np.uint64)


def signatures(doc: np.ndarray, element: np.ndarray, nth: np.ndarray, n_docs: int, k: int = BANDS * ROWS) -> np.ndarray:
    """k values for each text; texts without elements keep the largest value."""
    none = np.uint64(2**64 - 1)
    out = np.full((n_docs, k), none, np.uint64)
    weight = np.bincount(doc, minlength=n_docs)
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    base = mixed(element * np.uint64(0xD6E8FEB86659FD93) + nth)
    todo, darts = np.flatnonzero(weight), k * math.log(k) + 2 * k
    while len(todo):
        cost = weight[todo] * np.ceil(darts / weight[todo])
        group = (np.cumsum(cost) // _CELLS).astype(np.int64)
        for part in np.split(todo, np.flatnonzero(np.diff(group)) + 1):
            _throw(out, part, first, weight, base, darts)
        todo, darts = todo[(out[todo] == none).any(axis=1)], darts * 2
    return out


def _throw(out, texts, first, weight, base, darts):
    k = out.shape[1]
    limit = darts / weight[texts]
    rows = np.repeat(np.arange(len(texts)), weight[texts])
    own = np.concatenate([base[first[t] : first[t + 1]] for t in texts])
    cells = np.ceil(limit).astype(np.int64)[rows]
    row = np.repeat(rows, cells)
    ends = np.cumsum(cells)
    cell = (np.arange(len(row)) - np.repeat(ends - cells, cells)).astype(np.uint64)
    here = mixed(np.repeat(own, cells) + cell * np.uint64(0xA0761D6478BD642F))
    chance = (here >> np.uint64(11)).astype(np.float64) / 2**53
    top = (limit * 2**32).astype(np.uint64)
    flat = np.full(len(texts) * k, np.uint64(2**64 - 1), np.uint64)
    for q in range(12):
        more = np.flatnonzero(chance >= _CDF[q])
        if not len(more):
            break
        row, cell, here, chance = row[more], cell[more], here[more], chance[more]
        dart = mixed(here + _DARTS[q])
        rank = (cell << np.uint64(32)) | (dart & np.uint64(2**32 - 1))
        seen = rank < top[row]
        slot = row * k + ((dart >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
        np.minimum.at(flat, slot[seen], rank[seen])
    out[texts] = flat.reshape(len(texts), k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = signature.reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0x8EBC6AF09C88C6E3), part.shape[:2]).copy()
    for i in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, i])
    return key.view(np.int64)


def _elements_of(texts: list[str | None]):
    doc, shingle = shingles(words_of(texts), SHINGLE)
    return weighted_elements(doc, shingle)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            n = part.num_rows
            doc, element, nth = _elements_of(part.column("text").to_pylist())
            has = np.bincount(doc, minlength=n) > 0
            keys = band_keys(signatures(doc, element, nth, n)[has], BANDS, ROWS)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("node"), list_column(keys.ravel(), np.where(has, BANDS, 0), pa.int64())],
                names=["doc_id", "node", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            doc, element, nth = _elements_of(part.column("text").to_pylist())
            value = mixed(element * np.uint64(0xD6E8FEB86659FD93) + nth)
            ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
            blobs = [np.sort(value[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(blobs, pa.binary())], names=["node", "elements"])


def similarity(one: bytes, other: bytes) -> float:
    """Weighted Jaccard similarity; occurrences are elements of their own, so it is that of sets."""
    a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
    if not len(a) or not len(b):
        return 0.0
    both = np.sort(np.concatenate([a, b]))
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, other = batch.column("one").to_pylist(), batch.column("other").to_pylist()
        close = pa.array([similarity(x, y) >= SIMILARITY for x, y in zip(one, other)], pa.bool_())
        yield batch.select(["a", "b"]).filter(close)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, node, class, class_id, class_size): one row per input row.

    `node` is the MD5 of the text; equal texts are one node. Two nodes are linked if their weighted Jaccard similarity over
    shingles of five words is 0.8 or more; classes are the connected components; class_id is the least doc_id of the class.
    `class` is the least node of the class: where a doc_id stands on unlike texts, two classes can have one class_id.

    A NULL text is an empty one. Texts without words are alike only if they are equal. Texts of one to four words have one
    shingle. Rows with the same doc_id stay separate rows. A class whose ids are all NULL has a NULL class_id. Other columns
    are not read; an empty table gives an empty one.
    """
    keyed = _keyed(docs)
    rows = written(keyed.mapInArrow(_banded, "doc_id long, node binary, bands array<long>"), "bands")
    texts = rows.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    inside = written(_shared_buckets(texts.select("node", F.explode("bands").alias("bucket"))), "buckets")
    labels = _linked(keyed, rows, inside)
    member = rows.select("doc_id", "node").join(labels, "node", "left").withColumn("class", F.coalesce("component", "node"))
    member = written(member.drop("component"), "members")
    classes = member.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return member.join(classes, "class").select("doc_id", "node", "class", "class_id", "class_size")


def _node(text):
    return F.unhex(F.md5(text))


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _node(text).alias("node"), text.alias("text"))


def _shared_buckets(pairs: DataFrame) -> DataFrame:
    """(bucket, node, place) of the buckets with more than one text; place orders texts, those in the fullest buckets first.

    Copies of a text share more buckets with it than with each other, so the text itself comes first.
    """
    many = pairs.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    rows = written(pairs.join(many, "bucket"), "buckets")
    places = rows.groupBy("node").agg(F.sum("n").alias("n")).select("node", F.struct((-F.col("n")).alias("full"), "node").alias("place"))
    return rows.select("bucket", "node").join(places, "node")


def _linked(keyed: DataFrame, rows: DataFrame, inside: DataFrame) -> DataFrame:
    """(node, component) for the texts with a link.

    The pivot of a text is the first text of its buckets. First all texts are compared with their pivots, which links most
    copies. Then texts that aren't linked to their pivot are compared with all texts of the same pivot, in blocks. Texts of
    different pivots are compared where they share a bucket: the first text of a bucket with the others, then 16, 256, 4096
    more, while the texts after them differ in pivot and component. So no pair of a bucket is left out unless it is in one
    component already, and pairs inside a group of copies aren't listed.
    """
    reps = rows.groupBy("node").agg(F.min("doc_id").alias("rep"))
    needed = inside.select("node").distinct().join(reps, "node")
    found = (
        keyed.join(needed.select("node", F.col("rep").alias("doc_id")), ["node", "doc_id"])
        .unionByName(keyed.where("doc_id is null").join(needed.where("rep is null").select("node"), "node", "left_semi"))
        .dropDuplicates(["node"])
    )
    sets = written(found.mapInArrow(_sets, "node binary, elements binary"), "sets")
    hubs = inside.groupBy("bucket").agg(F.min("place").alias("hub"))
    nearest = inside.join(hubs, "bucket").groupBy("node").agg(F.min("hub").alias("hub"))
    pivots = written(nearest.select("node", F.col("hub.node").alias("pivot")), "pivots")
    edges = written(_checked(pivots.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")), sets), "links")
    labels = components(edges)
    more = written(_within_pivots(pivots, labels, sets), "links")
    if not more.isEmpty():
        edges = edges.union(more)
        labels = components(edges)
    inside = written(inside.join(pivots, "node"), "buckets")
    done, step = 0, 1
    while True:
        known = inside.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        hubs = written(_next_hubs(known, done, step), "hubs")
        if hubs.isEmpty():
            return labels
        pairs = (
            known.join(hubs, "bucket").where("place > hub and component != own and pivot != other")
            .select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct()
        )
        more = written(_checked(pairs, sets), "links")
        if not more.isEmpty():
            edges = edges.union(more)
            labels = components(edges)
        done, step = done + step, max(16, step * 16)


def _within_pivots(pivots: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) that join components, between texts not linked to their pivot and texts of the same pivot.

    Texts of a pivot are dealt to blocks by their hash; every block of the former meets every block of the latter.
    """
    known = pivots.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    center = known.where("node = pivot").select("pivot", F.col("component").alias("center"))
    known = known.where("node != pivot").join(center, "pivot", "left").withColumn("loose", ~F.col("component").eqNullSafe(F.col("center")))
    sizes = known.groupBy("pivot").agg(F.count("*").alias("n"), F.count_if("loose").alias("n_loose")).where("n > 1 and n_loose > 0")
    counts = sizes.select("pivot", F.ceil(F.col("n") / _BLOCK).cast("int").alias("rights"), F.ceil(F.col("n_loose") / _LOOSE).cast("int").alias("lefts"))
    rows = written(known.join(counts, "pivot").join(sets, "node"), "blocks")
    place = F.xxhash64("node")

    def dealt(some: DataFrame, own: str, other: str) -> DataFrame:
        mine = F.pmod(place, F.col(f"{own}s")).cast("int").alias(own)
        return some.select("pivot", "node", "component", "elements", mine, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1)).alias(other))

    keys = ["pivot", "left", "right"]
    left, right = dealt(rows.where("loose"), "left", "right"), dealt(rows, "right", "left")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_joining, "a binary, b binary")


def _shared(one: list[bytes], other: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sizes, sizes, common elements of each pair) of two blocks of texts."""
    sides = []
    for blobs in (one, other):
        parts = [np.frombuffer(b, np.uint64) for b in blobs]
        sides.append((np.repeat(np.arange(len(parts)), [len(p) for p in parts]), np.concatenate([*parts, np.zeros(0, np.uint64)]), np.array([len(p) for p in parts])))
    common = np.intersect1d(np.unique(sides[0][1]), np.unique(sides[1][1]))
    total = np.zeros((len(one), len(other)), np.float32)
    for at in range(0, len(common), 4096):
        some = common[at : at + 4096]
        tables = []
        for row, element, size in sides:
            column = np.minimum(np.searchsorted(some, element), len(some) - 1)
            hit = some[column] == element
            table = np.zeros((len(size), len(some)), np.float32)
            table[row[hit], column[hit]] = 1
            tables.append(table)
        total += tables[0] @ tables[1].T
    return sides[0][2], sides[1][2], total


def _joining(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links between two blocks; of those that join the same components one is enough."""
    if not left.num_rows or not right.num_rows:
        return pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
    a, b = left.column("node").to_pylist(), right.column("node").to_pylist()
    ca, cb = left.column("component").to_pylist(), right.column("component").to_pylist()
    n, m, common = _shared(left.column("elements").to_pylist(), right.column("elements").to_pylist())
    close = common >= SIMILARITY * (n[:, None] + m[None, :] - common) - 1e-3
    root: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        while root.get(x, x) != x:
            x = root[x]
        return x

    links = []
    for i, j in zip(*np.nonzero(close)):
        x, y = top(ca[i]), top(cb[j])
        if x != y and common[i, j] / (n[i] + m[j] - common[i, j]) >= SIMILARITY - 1e-9:
            root[max(x, y)] = min(x, y)
            links.append((a[i], b[j]))
    return pa.table({"a": pa.array([x for x, _ in links], pa.binary()), "b": pa.array([y for _, y in links], pa.binary())})


def _next_hubs(known: DataFrame, done: int, step: int) -> DataFrame:
    """(bucket, hub, own, other): the next texts of the buckets whose texts after the first `done` lie in several components
    and have several pivots."""
    ranked = known.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy("place"))).where(F.col("rank") <= done + step)
    last = ranked.where(F.col("rank") == done).select("bucket", F.col("place").alias("last"))
    rest = known.join(last, "bucket").where("place > last") if done else known
    several = [f(c).alias(f"{n}_{c}") for c in ("component", "pivot") for n, f in (("low", F.min), ("high", F.max))]
    open_ones = rest.groupBy("bucket").agg(*several).where("low_component != high_component and low_pivot != high_pivot")
    return (
        ranked.where(F.col("rank") > done).join(open_ones.select("bucket"), "bucket")
        .select("bucket", F.col("place").alias("hub"), F.col("component").alias("own"), F.col("pivot").alias("other"))
    )


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one = sets.select(F.col("node").alias("a"), F.col("elements").alias("one"))
    other = sets.select(F.col("node").alias("b"), F.col("elements").alias("other"))
    return pairs.join(one, "a").join(other, "b").mapInArrow(_verified, "a binary, b binary")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without near duplicates: of each class the row with the least (doc_id, node) stays, once.

    A row without a doc_id stays only where none of its class has one. A NULL text counts as an empty one, and all of these are one
    class. All columns are kept, whatever their names; an empty table stays empty.
    """
    member = near_duplicates(docs)
    # Struct fields in their order: rows with an id come first.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "node")).alias("k")
    kept = member.groupBy("class").agg(least).select("k.doc_id", "k.node")
    copies = member.groupBy("doc_id", "node").agg(F.count("*").alias("n"))
    same = F.col("k.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("k.node") == F.col("c.node"))
    kept = written(kept.alias("k").join(copies.alias("c"), same).select("k.doc_id", "k.node", "n"), "kept")
    node = _node(F.coalesce(F.col("text"), F.lit("")))
    on = docs["doc_id"].cast("long").eqNullSafe(kept["doc_id"]) & (node == kept["node"])
    # Under names that no column of the caller has.
    key = "kept_" + "_".join(sorted(docs.columns))
    found = docs.join(kept, on).select(*[docs[c] for c in docs.columns], kept["node"].alias(f"{key}_node"), kept["n"].alias(f"{key}_n"))
    # Only rows that come several times have to be brought together.
    single = found.where(F.col(f"{key}_n") == 1)
    several = found.where(F.col(f"{key}_n") > 1).dropDuplicates(["doc_id", f"{key}_node"])
    return single.unionByName(several).select(*docs.columns)
