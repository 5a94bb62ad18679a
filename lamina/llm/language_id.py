"""Languages by interpolated Kneser-Ney models over characters, four at a time.

Four characters of 16 bits are one 64-bit number. Counts are gathered from all learning documents, and all are kept: a model
is cut by the two middle characters into slices of about MAX_GRAMS runs, arrays sorted by a hash of the number, and a text
takes its sums slice by slice. The language with the least cross-entropy for each character is chosen; a text that is far
from all of them is marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.words import chunks, folded
from lamina.session import written

ORDER, FOLDS, HELD_OUT = 4, 4, 2
# Runs of a slice of the model; a task holds one slice at a time. Runs with the same middle characters share a slice.
MAX_GRAMS = 1_500_000
# Learning rows that are not counted but used to calibrate scores and rejection: about so many.
CALIBRATION_ROWS = 2_000
REJECT_SHARE = 0.005
NO_LANGUAGE = "und"
_MASK = [np.uint64((1 << (16 * n)) - 1) for n in range(ORDER + 1)]
_SHIFT = np.uint64(16)
# Less than 2**31, so that its product with two characters is a positive long in Spark too.
_PAIR = 1_481_765_933
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TOP = 18
# Each task passes its counts on when it holds so many different ones.
_HELD_GRAMS = 2_000_000
_LETTER = np.array([chr(c).isalpha() for c in range(0xD800)] + [False] * 0x800 + [chr(c).isalpha() for c in range(0xE000, 0x10000)])


def characters(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text, four characters as a number), one for each letter or gap of each text.

    Lower case; all that isn't a letter is a space, spaces in a row are one, and three stand before the first character.
    """
    raw = [("   " + folded(t)).encode("utf-32-le", "replace") for t in texts]
    code = np.frombuffer(b"".join(raw), np.uint32)
    size = np.array([len(r) // 4 for r in raw], np.int64)
    doc = np.repeat(np.arange(len(raw)), size)
    far = code > 0xFFFF
    # Characters beyond 16 bits share the private area.
    low = np.where(far, 0xE000 + code % 6400, code)
    letter = _LETTER[np.minimum(code, 0xFFFF)]
    if far.any():
        letter = letter.copy()
        letter[far] = [chr(c).isalpha() for c in code[far]]
    low = np.where(letter, low, 32).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    lead = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.zeros(0, np.int64)
    for i in range(3):
        keep[lead + i] = True
    low, doc = low[keep], doc[keep]
    if len(low) < ORDER:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    key = low[:-3] << np.uint64(48) | low[1:-2] << np.uint64(32) | low[2:-1] << _SHIFT | low[3:]
    inside = doc[3:] == doc[:-3]
    return doc[3:][inside], key[inside]


def _tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and the sum of their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts, first) if len(first) else first
    return keys[first], n.astype(np.int64)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def passed_on():
        for lang, parts in sorted(held.items()):
            keys, counts = _tally(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts)], names=["lang", "gram", "n"]
            )

    for batch in batches:
        for part in chunks(batch, "text"):
            texts, langs = part.column("text").to_pylist(), part.column("lang").to_pylist()
            doc, key = characters(texts)
            names = sorted(set(langs))
            of = np.array([names.index(x) for x in langs], np.int64)[doc]
            for i, lang in enumerate(names):
                found = _tally(key[of == i])
                held.setdefault(lang, []).append(found)
                size += len(found[0])
            if size > _HELD_GRAMS:
                for lang, parts in held.items():
                    held[lang] = [_tally(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))]
                size = sum(len(p[0][0]) for p in held.values())
                if size > _HELD_GRAMS // 2:
                    yield from passed_on()
                    held, size = {}, 0
    yield from passed_on()


class Order(NamedTuple):
    grams: np.ndarray
    share: np.ndarray  # discounted relative count
    contexts: np.ndarray
    spare: np.ndarray  # what is left for the shorter model


class Language(NamedTuple):
    orders: list[Order]  # of 1, 2, 3 and 4 characters
    floor: float  # probability of a character never seen


def _discount(one: int, two: int) -> float:
    return min(max(one / (one + 2 * two) if one else 0.5, 0.1), 0.95)


def _order(grams: np.ndarray, n: np.ndarray, discount: float | None = None) -> Order:
    if not len(grams):
        return Order(grams, np.zeros(0), grams, np.zeros(0))
    if discount is None:
        discount = _discount(int((n == 1).sum()), int((n == 2).sum()))
    context, types = _tally(grams >> _SHIFT)
    total = np.add.reduceat(n, np.flatnonzero(np.append(True, (grams >> _SHIFT)[1:] != (grams >> _SHIFT)[:-1])))
    at = np.searchsorted(context, grams >> _SHIFT)
    return Order(grams, (n - discount) / total[at], context, discount * types / total)


class Whole(NamedTuple):
    """What a slice can't know of its language by itself."""

    shorter: list[Order]  # of 1 and 2 characters
    discounts: list[float]  # of 3 and 4 characters


def language_of(grams: np.ndarray, n: np.ndarray, alphabet: int, whole: Whole | None = None) -> Language:
    """Kneser-Ney: the longest runs by count, shorter ones by the number of different characters before them.

    With `whole` the runs are those of a slice: it has all runs with the same two middle characters, hence all with the same
    first or last three, but not all with the same last two.
    """
    grams, n = _tally(grams, n)
    orders = [_order(grams, n, whole and whole.discounts[1])]
    for k in range(ORDER - 1, 2 if whole else 0, -1):
        grams, n = _tally(np.sort(grams & _MASK[k]))
        orders.insert(0, _order(grams, n, whole and whole.discounts[0]))
    return Language([*(whole.shorter if whole else []), *orders], 1.0 / (alphabet + 1))


def _found(keys: np.ndarray, wanted: np.ndarray, values: np.ndarray, other: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), other)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], other)


def probability(language: Language, grams: np.ndarray) -> np.ndarray:
    p = np.full(len(grams), language.floor)
    for k, order in enumerate(language.orders, 1):
        part = grams & _MASK[k]
        p = _found(order.grams, part, order.share, 0.0) + _found(order.contexts, part >> _SHIFT, order.spare, 1.0) * p
    return p


class Slice(NamedTuple):
    languages: list[Language]
    hashes: np.ndarray  # of all known runs, ascending
    first: np.ndarray  # where the hashes with the same leading bits begin
    longest: int  # most hashes with the same leading bits
    logs: np.ndarray  # for each of them and each language


class Model(NamedTuple):
    names: list[str]
    slices: list[Broadcast]  # of Slice
    sharpness: float
    limit: np.ndarray  # of cross-entropy, for each language


def build(rows: list[tuple[np.ndarray, np.ndarray]], alphabet: int, whole: list[Whole | None]) -> Slice:
    """Slice from (runs, counts) of each language; `whole` is None where they are all runs of the language."""
    grams = _tally(np.concatenate([r[0] for r in rows]))[0]
    languages = [language_of(r[0], r[1], alphabet, w) for r, w in zip(rows, whole)]
    logs = np.stack([np.log(probability(x, grams)) for x in languages], axis=1)
    hashes = grams * _ODD
    order = np.argsort(hashes)
    hashes, logs = hashes[order], logs[order].astype(np.float32)
    first = np.searchsorted(hashes, np.arange(1 << _TOP, dtype=np.uint64) << np.uint64(64 - _TOP))
    longest = int(np.diff(np.append(first, len(hashes))).max())
    return Slice(languages, hashes, first, longest, logs)


def _slice_of(keys: np.ndarray, n: int) -> np.ndarray:
    return (((keys >> _SHIFT) & _MASK[2]) * np.uint64(_PAIR) >> np.uint64(31)) % np.uint64(n)


def _logs(key: np.ndarray, part: Slice) -> np.ndarray:
    """Log probability of each run in each language of the slice."""
    if not len(part.hashes):
        seldom, back = np.unique(key, return_inverse=True)
        return np.stack([np.log(probability(x, seldom)) for x in part.languages], axis=1)[back]
    h = key * _ODD
    at = part.first[(h >> np.uint64(64 - _TOP)).astype(np.intp)]
    last = len(part.hashes) - 1
    for _ in range(part.longest - 1):
        behind = np.flatnonzero(part.hashes[np.minimum(at, last)] < h)
        if not len(behind):
            break
        at[behind] += 1
    at = np.minimum(at, last)
    new = np.flatnonzero(part.hashes[at] != h)
    logs = part.logs[at].astype(np.float64)
    if len(new):
        seldom, back = np.unique(key[new], return_inverse=True)
        logs[new] = np.stack([np.log(probability(x, seldom)) for x in part.languages], axis=1)[back]
    return logs


def cross_entropy(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(nats for each character in each language, characters) of each text."""
    doc, key = characters(texts)
    total = np.zeros((len(texts), len(model.names)))
    of = _slice_of(key, len(model.slices)) if len(model.slices) > 1 else None
    for i, shared in enumerate(model.slices):
        own = slice(None) if of is None else np.flatnonzero(of == i)
        at, runs = doc[own], key[own]
        if not len(runs):
            continue
        # One of several slices isn't kept in memory.
        logs = _logs(runs, shared.value if of is None else shared.load_from_path(shared._path))
        starts = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        total[at[starts]] += np.add.reduceat(logs, starts)
    size = np.bincount(doc, minlength=len(texts))
    return -total / np.maximum(size, 1)[:, None], size


def _posterior(entropy: np.ndarray, sharpness: float) -> np.ndarray:
    z = -entropy * sharpness
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def calibrated(model: Model, texts: list[str | None], langs: list[str]) -> Model:
    """Sharpness by likelihood; the limits leave out REJECT_SHARE of each language's texts."""
    known = {x: i for i, x in enumerate(model.names)}
    some = [(t, known[x]) for t, x in sorted(zip(texts, langs), key=lambda r: (r[1], r[0] or "")) if x in known and t]
    if not some:
        return model
    entropy, size = cross_entropy([t for t, _ in some], model)
    own = np.array([i for _, i in some])
    entropy, own = entropy[size > 0], own[size > 0]
    if not len(own):
        return model
    at = np.arange(len(own))
    grid = [2.0**e for e in range(-2, 9)]
    loss = [-np.log(np.maximum(_posterior(entropy, g)[at, own], 1e-12)).mean() for g in grid]
    mine = entropy[at, own]
    # A language without such texts takes the limit of all.
    of = [mine[own == i] if (own == i).any() else mine for i in range(len(model.names))]
    limit = np.array([np.quantile(m, 1 - REJECT_SHARE) for m in of])
    return model._replace(sharpness=grid[int(np.argmin(loss))], limit=limit)


def train(docs: DataFrame) -> Model:
    """Counts all documents outside the held-out fold that have a language, but for the rows kept for calibration."""
    doc_id = F.col("doc_id").cast("long").cast("string")
    rows = docs.where((F.crc32(doc_id) % FOLDS != HELD_OUT) & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    total = rows.select("lang").count()
    share = min(0.1, CALIBRATION_ROWS / max(1, total))
    aside = F.pmod(F.xxhash64(doc_id), F.lit(1_000_000)) < share * 1_000_000
    counts = written(
        rows.where(~aside).select("text", "lang").mapInArrow(_counted, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams",
    )
    model = Model([], [], 1.0, np.zeros(0))
    for names, part in _sliced(counts):
        model = Model(names, [*model.slices, docs.sparkSession.sparkContext.broadcast(part)], 1.0, np.full(len(names), np.inf))
    if not model.names:
        return model
    kept = rows.where(aside).select("text", "lang")
    calibration = kept.repartition(1).mapInArrow(lambda batches: _calibration(batches, model), "sharpness double, limits array<double>").collect()
    if not calibration:
        return model
    return model._replace(sharpness=calibration[0][0], limit=np.array(calibration[0][1]))


def _by_language(counts: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """(runs, counts) of each language, on the driver."""
    table = counts.select("lang", "gram", "n").orderBy("lang", "gram").toArrow()
    lang = np.array(table.column("lang").to_pylist(), object)
    gram, n = table.column("gram").to_numpy().view(np.uint64), table.column("n").to_numpy()
    return {x: (gram[lang == x], n[lang == x]) for x in sorted(set(lang))}


def _sliced(counts: DataFrame) -> Iterator[tuple[list[str], Slice]]:
    """(languages, slice) one by one, from all counts; without counts there is none."""
    total = counts.count()
    if total <= MAX_GRAMS:
        rows = _by_language(counts)
        if rows:
            alphabet = len(_tally(np.concatenate([g for g, _ in rows.values()]) & _MASK[1])[0])
            yield list(rows), build(list(rows.values()), alphabet, [None] * len(rows))
        return
    pair = F.shiftrightunsigned("gram", 16).bitwiseAND(F.lit(int(_MASK[2])))
    pairs = written(counts.groupBy(pair.alias("pair")).agg(F.count("*").alias("n")), "pairs")

    def place(of, n: int):
        return F.shiftright(of * F.lit(_PAIR).cast("long"), 31) % n

    n_slices = -(-total // MAX_GRAMS)
    most = max(MAX_GRAMS, 2 * pairs.agg(F.max("n")).first()[0])
    while pairs.groupBy(place(F.col("pair"), n_slices).alias("at")).agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0] > most:
        n_slices *= 2
    names, alphabet, whole = _whole(counts)
    counts = written(counts.withColumn("at", place(pair, n_slices)).repartition("at"), "grams")
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    for at in range(n_slices):
        rows = _by_language(counts.where(F.col("at") == at))
        yield names, build([rows.get(x, none) for x in names], alphabet, [whole[x] for x in names])


def _whole(counts: DataFrame) -> tuple[list[str], int, dict[str, Whole]]:
    """Languages, size of the alphabet, and what slices need of each language, from all its runs."""
    longer, orders = [counts], {}
    for k in range(ORDER - 1, 0, -1):
        some = longer[0].groupBy("lang", F.col("gram").bitwiseAND(F.lit(int(_MASK[k]))).alias("gram")).agg(F.count("*").alias("n"))
        longer.insert(0, written(some, "grams"))
    for part in longer[:2]:
        for lang, (grams, n) in _by_language(part).items():
            orders.setdefault(lang, []).append(_order(grams, n))
    discounts = {lang: [] for lang in orders}
    for part in longer[2:]:
        for r in part.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("one"), F.count_if(F.col("n") == 2).alias("two")).collect():
            discounts[r.lang].append(_discount(r.one, r.two))
    return sorted(orders), longer[0].select("gram").distinct().count(), {x: Whole(orders[x], discounts[x]) for x in orders}


def _calibration(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    texts, langs = [], []
    for batch in batches:
        texts += batch.column("text").to_pylist()
        langs += batch.column("lang").to_pylist()
    model = calibrated(model, texts, langs)
    yield pa.RecordBatch.from_arrays(
        [pa.array([model.sharpness]), pa.array([model.limit.tolist()], pa.list_(pa.float64()))], names=["sharpness", "limits"]
    )


def predict_texts(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, rejected) of each text."""
    has = np.array([any(map(str.isalpha, t or "")) for t in texts], bool)
    names, score, rejected = [NO_LANGUAGE] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    if model.names and has.any():
        entropy, _ = cross_entropy(texts, model)
        best = entropy.argmin(axis=1)
        at = np.arange(len(texts))
        score = np.where(has, _posterior(entropy, model.sharpness)[at, best], 0.0)
        rejected = ~has | (entropy[at, best] > model.limit[best])
        names = [model.names[b] if h else NO_LANGUAGE for b, h in zip(best, has)]
    return names, score, rejected


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected), one row per input row.

    lang_pred is the learned language with the least cross-entropy (the first by name among equals), `und` if the text is
    NULL or has no letter, or nothing was learned; score is its calibrated probability, 0 for `und`. `rejected` marks texts
    farther from their language than its own texts are; they keep their lang_pred. held_out is false where doc_id is NULL.
    Other columns are not read; an empty table gives an empty one.
    """
    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                names, score, rejected = predict_texts(part.column("text").to_pylist(), model)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                    names=["doc_id", "lang_pred", "score", "rejected"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        predicted, "doc_id long, lang_pred string, score double, rejected boolean"
    )
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
