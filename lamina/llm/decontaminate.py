"""Benchmark passages in documents, found by SimHash windows and checked by weighted shingles.

Windows about as long as an item slide over every text. Their 64-bit SimHash over word pairs is looked up in four block
tables that hold all 16-bit values within three bits of an item's block: two fingerprints within 15 bits of each other
agree within three bits in at least one of the four blocks, so no fingerprint within the radius is missed. Candidates are
then compared exactly, at every start near the window, by shingles of five words weighted by their rarity in the benchmark.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.words import chunks, joined, words_of
from lamina.session import written

SIMILARITY, SHINGLE, RADIUS = 0.8, 5, 15
# Longer items are cut into equal parts of at most so many words; each part is looked for like an item.
PART_WORDS = 120
# Parts whose index one task holds at a time, on average; a larger benchmark takes more passes.
BLOCK_PARTS = 5_000
_GROUP = 64
# Windows computed at once, so that they stay in the cache.
_WINDOWS = 8192
_BYTES = np.arange(256, dtype=np.uint64)
# The bits of a byte as the bytes of a number.
_LANES = sum((((_BYTES >> np.uint64(b)) & np.uint64(1)) << np.uint64(8 * b)) for b in range(8))
_HIGH, _ONES = np.uint64(0x8080808080808080), np.uint64(0x0101010101010101)
_PACK = np.uint64(0x0102040810204080)
_NEAR16 = np.array([sum(1 << b for b in c) for n in range(RADIUS // 4 + 1) for c in itertools.combinations(range(16), n)])


class Part(NamedTuple):
    item_id: int
    words: int
    shingles: np.ndarray
    weights: dict[int, float]  # of the shingles in the part, occurrences counted
    total: float


class Group(NamedTuple):
    size: int  # words in a window
    parts: list[Part]
    prints: np.ndarray
    tables: np.ndarray  # for each of the four blocks: value -> bits of the parts with that value nearby


class Index(NamedTuple):
    groups: list[Group]
    weight: dict[int, float]  # of the shingles of these items
    unseen: float  # of a shingle that the item at hand doesn't hold


def _running(pairs: np.ndarray) -> np.ndarray:
    """For each of 8 bytes, running sums of its bits in 8 lanes; differences are counts in a window."""
    sums = np.zeros((len(pairs) + 1, 8), np.uint64)
    np.cumsum(np.take(_LANES, pairs.view(np.uint8).reshape(-1, 8)), axis=0, out=sums[1:])
    return sums


def _prints(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of the word pairs [start, end): each bit is that of the majority. At most 255 pairs."""
    out = np.empty(len(start), np.uint64)
    for at in range(0, len(start), _WINDOWS):
        a, b = start[at : at + _WINDOWS], end[at : at + _WINDOWS]
        lanes = np.take(sums, b, axis=0)
        lanes -= np.take(sums, a, axis=0)
        # A lane's highest bit is set if more than half of the pairs have the bit.
        lanes += ((np.uint64(127) - ((b - a) // 2).astype(np.uint64)) * _ONES)[:, None]
        lanes &= _HIGH
        lanes >>= np.uint64(7)
        lanes *= _PACK
        lanes >>= np.uint64(56)
        out[at : at + _WINDOWS] = lanes.astype(np.uint8).view(np.uint64)[:, 0]
    return out


def _window(words: int) -> int:
    """Window length for parts of so many words, at most 5 % off."""
    return round(1.1 ** round(math.log(words, 1.1)))


def build_index(items: list[tuple[int, str]], items_of: dict[int, int], n_items: int) -> Index:
    """Index of some items; items_of: in how many items of the whole benchmark each shingle is."""
    weight = {s: 1 + math.log(n_items / n) for s, n in items_of.items()}
    by_size: dict[int, list[tuple[Part, np.uint64]]] = {}
    for item_id, text in items:
        hashes = words_of([text]).hash
        if len(hashes) < SHINGLE:
            continue
        pieces = -(-len(hashes) // PART_WORDS)
        for piece in np.array_split(hashes, pieces):
            shingles = joined(piece, SHINGLE)
            count = Counter(shingles.tolist())
            weights = {s: n * weight[s] for s, n in count.items() if s in weight}
            part = Part(item_id, len(piece), np.array(sorted(weights), np.uint64), weights, sum(weights.values()))
            pairs = joined(piece, 2)
            mark = _prints(_running(pairs), np.array([0]), np.array([len(pairs)]))[0]
            by_size.setdefault(_window(len(piece)), []).append((part, mark))
    groups = []
    for size, found in sorted(by_size.items()):
        for at in range(0, len(found), _GROUP):
            some = found[at : at + _GROUP]
            prints = np.array([p for _, p in some], np.uint64)
            tables = np.zeros((4, 1 << 16), np.uint64)
            for i, mark in enumerate(prints):
                for block in range(4):
                    value = int(mark >> np.uint64(16 * block)) & 0xFFFF
                    tables[block, value ^ _NEAR16] |= np.uint64(1 << i)
            groups.append(Group(size, [p for p, _ in some], prints, tables))
    return Index(groups, weight, 1 + math.log(max(1, n_items)))


class Windows(NamedTuple):
    doc: np.ndarray
    start: np.ndarray
    marks: np.ndarray


def _windows(size: int, sums, first, last) -> Windows:
    """Fingerprints of the windows of one size; first, last: words of each text."""
    step = max(1, size // 8)
    n_words = last - first
    # Every step-th start of a text, and its last window; a text that is a little shorter is one window.
    counts = np.where(n_words >= size, (n_words - size) // step + 2, (n_words >= 0.7 * size).astype(np.int64))
    doc = np.repeat(np.arange(len(first)), counts)
    ends = np.cumsum(counts)
    nth = np.arange(len(doc)) - np.repeat(ends - counts, counts)
    start = np.minimum(first[doc] + nth * step, np.maximum(last[doc] - size, first[doc]))
    end = np.minimum(start + size, last[doc]) - 1
    return Windows(doc, start, _prints(sums, start, end))


def _candidates(group: Group, windows: Windows) -> Iterator[tuple[int, int, np.ndarray]]:
    """(text, part, window starts) with fingerprints within the radius."""
    doc, start, marks = windows
    if not len(doc):
        return
    values = marks.view(np.uint16).reshape(-1, 4)
    near = np.take(group.tables[0], values[:, 0])
    for block in range(1, 4):
        near |= np.take(group.tables[block], values[:, block])
    some = np.flatnonzero(near)
    marks, near = marks[some], near[some]
    for i, mark in enumerate(group.prints):
        close = (np.bitwise_count(marks ^ mark) <= RADIUS) & ((near >> np.uint64(i)) & np.uint64(1) == 1)
        at = some[close]
        if len(at):
            for d, starts in itertools.groupby(zip(doc[at].tolist(), start[at].tolist()), key=lambda x: x[0]):
                yield d, i, np.array([s for _, s in starts])


def _best(part: Part, index: Index, shingles: np.ndarray, starts: np.ndarray, slack: int, first: int, last: int) -> tuple[float, int]:
    """Highest similarity of the part with a window of as many words that starts within `slack` of a start.

    Shingles of the window that the part doesn't hold weigh as much as the rarest, whatever other items hold them, so that a
    similarity depends on the item and the counts of its own shingles alone."""
    length = min(part.words, last - first)
    n = length - SHINGLE + 1
    tried = np.unique((starts[:, None] + np.arange(-slack, slack + 1)).ravel())
    tried = tried[(tried >= first) & (tried + length <= last)]
    if n < 1 or not len(tried):
        return 0.0, first
    low = int(tried[0])
    near = shingles[low : int(tried[-1]) + n].tolist()
    shared = np.zeros(len(near) + 1)
    np.cumsum([index.weight.get(s, 0.0) if s in part.weights else 0.0 for s in near], out=shared[1:])
    best, where = 0.0, first
    for s in tried.tolist():
        # What is shared is at most this.
        if shared[s - low + n] - shared[s - low] < SIMILARITY * part.total:
            continue
        mine = {x: c * (index.weight[x] if x in part.weights else index.unseen) for x, c in Counter(near[s - low : s - low + n]).items()}
        both = sum(min(w, part.weights.get(x, 0.0)) for x, w in mine.items())
        score = both / (part.total + sum(mine.values()) - both)
        if score > best:
            best, where = score, s
    return best, where


def matches(texts: list[str | None], index: Index) -> Iterator[tuple[int, int, int, int, float]]:
    """(text, item_id, first word, words, similarity): the best place of each item in each text, if it is 0.8 or more."""
    words = words_of(texts)
    first = np.searchsorted(words.doc, np.arange(len(texts)))
    last = np.searchsorted(words.doc, np.arange(len(texts)), side="right")
    shingles, sums = joined(words.hash, SHINGLE), _running(joined(words.hash, 2))
    found: dict[tuple[int, int], tuple[float, int, int]] = {}
    size, windows = 0, None
    for group in index.groups:
        if group.size != size:
            # Groups are in the order of their sizes.
            size, windows = group.size, _windows(group.size, sums, first, last)
        slack = max(1, group.size // 8) + math.ceil(0.05 * group.size) + 1
        for d, i, starts in _candidates(group, windows):
            part = group.parts[i]
            score, at = _best(part, index, shingles, starts, slack, int(first[d]), int(last[d]))
            if score >= SIMILARITY:
                key, hit = (d, part.item_id), (score, -int(at - first[d]), part.words)
                found[key] = max(found.get(key, hit), hit)
    for (d, item_id), (score, at, n) in sorted(found.items()):
        yield d, item_id, -at, n, score


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different shingles of each item, and into how many parts it is cut."""
    for batch in batches:
        hashes = [words_of([text]).hash for text in batch.column("text").to_pylist()]
        shingles = [np.unique(joined(h, SHINGLE)).view(np.int64).tolist() for h in hashes]
        parts = [-(-len(h) // PART_WORDS) for h in hashes]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), batch.column("text"), pa.array(shingles, pa.list_(pa.int64())), pa.array(parts, pa.int64())],
            names=["item_id", "text", "shingles", "parts"],
        )


def _blocks(benchmark: DataFrame) -> tuple[int, Callable[[int], Index]]:
    """How many blocks of about BLOCK_PARTS parts there are, and a maker of the index of one.

    In how many items a shingle is, is counted in Spark over the whole benchmark; a block gets the counts of its own shingles.
    """
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    rows = written(items.mapInArrow(_parts, "item_id long, text string, shingles array<long>, parts long"), "items")
    total, parts = rows.agg(F.count("*"), F.coalesce(F.sum("parts"), F.lit(0))).first()
    blocks = max(1, math.ceil(parts / BLOCK_PARTS))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    counts = rows.select(F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("n"))
    if blocks > 1:
        counts = written(counts, "shingles")

    def made(b: int) -> Index:
        own = rows.where(block == b)
        found = own.select("item_id", "text").collect()
        known = counts if blocks == 1 else counts.join(own.select(F.explode("shingles").alias("shingle")).distinct(), "shingle", "left_semi")
        items_of = {r["shingle"] & (2**64 - 1): r["n"] for r in known.collect()}
        return build_index(sorted(((r[0], r[1]) for r in found), key=lambda r: (r[0] is None, r[0] or 0, r[1])), items_of, max(1, total))

    return blocks, made


def _passes(rows: DataFrame, benchmark: DataFrame, task, schema, label: str, chained: bool) -> list[DataFrame]:
    """`task(index)` over the rows for each block of the benchmark; chained: each over what the one before left.

    With several blocks the result of each is written before the next index is made, so that one is held at a time.
    """
    context = rows.sparkSession.sparkContext
    blocks, made = _blocks(benchmark)
    out = []
    for b in range(blocks):
        shared = context.broadcast(made(b))
        one = rows.mapInArrow(task(shared), schema)
        if blocks > 1:
            one = written(one, label)
            shared.destroy()
        out.append(one)
        if chained:
            rows = one
    return out


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_id, first_word, n_words, similarity), one row per distinct doc_id.

    item_id is the most similar item (the least id among equals), first_word and n_words its place. Without a match they are
    NULL and similarity is 0. A NULL text has no words. Items of fewer than five words can't be told from chance and take no
    part, nor do NULL items. Rows with the same doc_id are reported together. Other columns are not read; an empty table
    gives an empty one, an empty benchmark finds nothing.
    """
    schema = "doc_id long, n_items long, hit struct<similarity: double, item_id: long, first_word: long, n_words: long>"
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def report_with(shared):
        def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch, "text"):
                    n, best = [0] * part.num_rows, [None] * part.num_rows
                    for d, item_id, at, size, score in matches(part.column("text").to_pylist(), shared.value):
                        n[d] += 1
                        if best[d] is None or score > best[d]["similarity"]:
                            best[d] = {"similarity": score, "item_id": item_id, "first_word": at, "n_words": size}
                    kind = pa.struct([("similarity", pa.float64()), ("item_id", pa.int64()), ("first_word", pa.int64()), ("n_words", pa.int64())])
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(best, kind)], names=["doc_id", "n_items", "hit"])

        return report

    passes = _passes(keyed, benchmark, report_with, schema, "leaks", chained=False)
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    best = F.max(F.when(F.col("hit").isNotNull(), F.struct("hit.similarity", (-F.col("hit.item_id")).alias("item"), "hit.first_word", "hit.n_words")))
    return every.groupBy("doc_id").agg(F.sum("n_items").alias("n_items"), best.alias("b")).select(
        "doc_id", (F.col("n_items") > 0).alias("contaminated"), "n_items", (-F.col("b.item")).alias("item_id"),
        F.col("b.first_word"), F.col("b.n_words"), F.coalesce("b.similarity", F.lit(0.0)).alias("similarity"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` whose text holds no item; the same test as in leak_report, all columns kept, no shuffle.

    Rows with a NULL text or without words stay, repeated rows stay or go alike; an empty table stays empty.
    """
    def clean_with(shared):
        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in chunks(batch, "text"):
                    keep = np.ones(part.num_rows, bool)
                    keep[[d for d, *_ in matches(part.column("text").to_pylist(), shared.value)]] = False
                    yield part.filter(pa.array(keep))

        return clean

    return _passes(docs, benchmark, clean_with, docs.schema, "clean", chained=True)[-1]
