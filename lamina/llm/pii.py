"""Personal data: fixed patterns, and a character model that finds what the patterns miss.

The model is a bidirectional LSTM over characters with CRF transitions between tags, trained in numpy on spans that the
patterns label. It reads windows that overlap by half; the decoded windows are reconciled over the whole text. What it
finds is kept only if it could be data of that kind (see `admissible`) and touches no span of the patterns. A window that
holds neither an @ nor four digits can't contain an admissible span, so it is not decoded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lamina.llm.words import chunks

KINDS = ("email", "ip", "card", "phone")
# At most about so many documents are learned from, and so many windows of each.
SAMPLE_ROWS, SAMPLE_WINDOWS = 1_500, 4
WINDOW, STRIDE = 128, 64
_TRAIN, _HIDDEN, _EMBED, _STEPS, _BATCH, _RATE = 64, 16, 12, 240, 64, 0.02
_N_CHARS, _N_TAGS = 132, 1 + 2 * len(KINDS)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[@0-9]")
Span = tuple[int, int, int]  # kind, start, end


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # The local part is the run before an @, as far back as the last match.
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
        done = match.end() if match else at + 1
        at = text.find("@", done)


def _short(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns by kind, then start, in code points; matches that fail their test are dropped."""
    if not _ANY.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(map(_short, m[0].split(".")))]
    out += [(2, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def admissible(kind: int, text: str) -> bool:
    """Could this be data of that kind, if written in another way than the patterns ask for?"""
    if kind == 0:
        name, at, host = text.partition("@")
        return bool(at and name.strip() and "." in host.strip(".") and not re.search(r"[\s@]", name + host))
    digits = _digits(text)
    if kind == 1:
        parts = re.split(r"[^0-9]+", text)
        return len(parts) == 4 and all(p and _short(p) for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and text[:1] in "+(0" and not re.search(r"[^\W\d]", text)


def _codes(text: str) -> np.ndarray:
    """Characters as small numbers: ASCII as it is, beyond it letters, spaces and the rest; 131 fills up."""
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    out = np.minimum(raw, 128).astype(np.int64)
    for i in np.flatnonzero(raw > 127):
        c = chr(raw[i])
        out[i] = 128 if c.isalpha() else 129 if c.isspace() else 130
    return out


class Network(NamedTuple):
    """The first axis of `inner`, `outer` and `bias` is the direction."""

    embed: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    bias: np.ndarray
    emit: np.ndarray
    emit_bias: np.ndarray
    moves: np.ndarray  # CRF score from tag to tag; the last row begins a window


def _fresh(seed: int = 5) -> Network:
    rng = np.random.default_rng(seed)
    h = _HIDDEN
    bias = np.zeros((2, 4 * h))
    bias[:, h : 2 * h] = 1.0
    return Network(
        rng.normal(0, 0.3, (_N_CHARS, _EMBED)), rng.normal(0, 0.3, (2, _EMBED, 4 * h)), rng.normal(0, 0.2, (2, h, 4 * h)), bias,
        rng.normal(0, 0.3, (2 * h, _N_TAGS)), np.zeros(_N_TAGS), np.zeros((_N_TAGS + 1, _N_TAGS)),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(net: Network, codes: np.ndarray, keep: bool = False):
    """Emission scores (window, place, tag); with `keep` also what the backward pass needs."""
    n, size = codes.shape
    h = _HIDDEN
    both = np.stack([codes, codes[:, ::-1]])
    x = net.embed[both]
    gates_in = np.matmul(x.reshape(2, n * size, -1), net.inner).reshape(2, n, size, 4 * h) + net.bias[:, None, None, :]
    hidden, cell = np.zeros((2, n, h)), np.zeros((2, n, h))
    states = np.zeros((2, n, size, h))
    memory = []
    for t in range(size):
        z = gates_in[:, :, t] + np.matmul(hidden, net.outer)
        s = _sigmoid(z[..., : 3 * h])
        i, f, o, g = s[..., :h], s[..., h : 2 * h], s[..., 2 * h :], np.tanh(z[..., 3 * h :])
        before, cell = cell, f * cell + i * g
        squashed = np.tanh(cell)
        if keep:
            memory.append((hidden, before, i, f, o, g, squashed))
        hidden = o * squashed
        states[:, :, t] = hidden
    joint = np.concatenate([states[0], states[1][:, ::-1]], axis=2)
    scores = joint @ net.emit + net.emit_bias
    return (scores, both, x, joint, memory) if keep else scores


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _gradients(net: Network, codes: np.ndarray, tags: np.ndarray) -> Network:
    """Of the mean negative log likelihood of the tags."""
    scores, both, x, joint, memory = _forward(net, codes, keep=True)
    n, size = codes.shape
    h, moves = _HIDDEN, net.moves[:-1]
    ahead = np.zeros_like(scores)
    ahead[:, 0] = net.moves[-1] + scores[:, 0]
    for t in range(1, size):
        ahead[:, t] = _log_sum(ahead[:, t - 1][:, :, None] + moves, 1) + scores[:, t]
    back = np.zeros_like(scores)
    for t in range(size - 2, -1, -1):
        back[:, t] = _log_sum(moves + (scores[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    total = _log_sum(ahead[:, -1], 1)
    d_scores = np.exp(ahead + back - total[:, None, None])
    d_moves = np.zeros_like(net.moves)
    d_moves[-1] = d_scores[:, 0].sum(0)
    for t in range(1, size):
        d_moves[:-1] += np.exp(ahead[:, t - 1][:, :, None] + moves + (scores[:, t] + back[:, t])[:, None, :] - total[:, None, None]).sum(0)
    np.add.at(d_moves, (np.full(n, _N_TAGS), tags[:, 0]), -1)
    np.add.at(d_moves, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
    rows, places = np.ogrid[:n, :size]
    d_scores[rows, places, tags] -= 1
    d_joint = d_scores @ net.emit.T
    d_states = np.stack([d_joint[..., :h], d_joint[:, ::-1, h:]])
    d_gates = np.zeros((2, n, size, 4 * h))
    d_outer, d_hidden, d_cell = np.zeros_like(net.outer), np.zeros((2, n, h)), np.zeros((2, n, h))
    for t in range(size - 1, -1, -1):
        hidden, before, i, f, o, g, squashed = memory[t]
        dh = d_states[:, :, t] + d_hidden
        dc = dh * o * (1 - squashed**2) + d_cell
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=2)
        d_gates[:, :, t] = dz
        d_outer += np.matmul(hidden.transpose(0, 2, 1), dz)
        d_hidden, d_cell = np.matmul(dz, net.outer.transpose(0, 2, 1)), dc * f
    flat = d_gates.reshape(2, n * size, 4 * h)
    d_inner = np.matmul(x.reshape(2, n * size, -1).transpose(0, 2, 1), flat)
    d_embed = np.zeros_like(net.embed)
    np.add.at(d_embed, both.reshape(2, -1), np.matmul(flat, net.inner.transpose(0, 2, 1)))
    d_emit = joint.reshape(n * size, -1).T @ d_scores.reshape(n * size, -1)
    out = Network(d_embed, d_inner, d_outer, flat.sum(1), d_emit, d_scores.sum((0, 1)), d_moves)
    return Network(*(g / n for g in out))


def tags_of(spans: list[Span], size: int) -> np.ndarray:
    """0 outside; 1 + 2k begins a span of kind k, 2 + 2k goes on. Earlier kinds win where spans overlap."""
    tags = np.zeros(size, np.int64)
    for kind, a, b in sorted(spans, reverse=True):
        tags[a:b] = 2 + 2 * kind
        tags[a] = 1 + 2 * kind
    return tags


def fit(texts: list[str]) -> Network:
    """Learns the spans of the patterns; windows lie around digits and @, so failing matches are learned as none."""
    rng = np.random.default_rng(3)
    codes, tags = [], []
    for text in texts:
        c, t = _codes(text), tags_of(base_spans(text), len(text))
        places = [m.start() for m in _ANY.finditer(text)]
        for p in rng.choice(places, SAMPLE_WINDOWS) if places else rng.integers(0, max(1, len(text)), 1):
            a = max(0, int(p) - int(rng.integers(0, _TRAIN)))
            fill = _TRAIN - len(c[a : a + _TRAIN])
            codes.append(np.append(c[a : a + _TRAIN], np.full(fill, _N_CHARS - 1)))
            tags.append(np.append(t[a : a + _TRAIN], np.zeros(fill, np.int64)))
    net = _fresh()
    if not codes or not any(t.any() for t in tags):
        return net
    codes, tags = np.stack(codes), np.stack(tags)
    first, second = Network(*map(np.zeros_like, net)), Network(*map(np.zeros_like, net))
    for step in range(1, _STEPS + 1):
        some = rng.integers(0, len(codes), _BATCH)
        grad = _gradients(net, codes[some], tags[some])
        first = Network(*(0.9 * m + 0.1 * g for m, g in zip(first, grad)))
        second = Network(*(0.99 * v + 0.01 * g**2 for v, g in zip(second, grad)))
        rate = _RATE * min(1.0, 2 * (1 - step / (_STEPS + 1))) * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
        net = Network(*(w - rate * m / (np.sqrt(v) + 1e-6) for w, m, v in zip(net, first, second)))
    return net


def decoded(net: Network, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best tags, how far each chosen tag's emission is above the best other one)."""
    scores = _forward(net, codes)
    n, size = codes.shape
    best = net.moves[-1] + scores[:, 0]
    came = np.zeros((size, n, _N_TAGS), np.int64)
    for t in range(1, size):
        step = best[:, :, None] + net.moves[:-1]
        came[t] = step.argmax(1)
        best = step.max(1) + scores[:, t]
    tags = np.zeros((n, size), np.int64)
    tags[:, -1] = best.argmax(1)
    for t in range(size - 1, 0, -1):
        tags[:, t - 1] = came[t][np.arange(n), tags[:, t]]
    rows, places = np.ogrid[:n, :size]
    chosen = scores[rows, places, tags]
    rest = scores.copy()
    rest[rows, places, tags] = -np.inf
    return tags, chosen - rest.max(2)


def _windows(text: str) -> list[int]:
    """Starts of the windows that can hold an admissible span."""
    spots = np.array([m.start() for m in _ANY.finditer(text)])
    out = []
    for start in np.unique(np.concatenate([np.maximum(spots // STRIDE - 1, 0), spots // STRIDE])) * STRIDE if len(spots) else []:
        inside = spots[np.searchsorted(spots, start) : np.searchsorted(spots, start + WINDOW)]
        if len(inside) >= 4 or any(text[i] == "@" for i in inside):
            out.append(int(start))
    return out


def model_spans(texts: list[str], net: Network, at_once: int = 256) -> list[list[Span]]:
    """What the model finds in each text, reconciled over its windows.

    Every window gives its spans; one that touches an inner edge of its window is left to the neighbour that sees it
    whole. Of overlapping spans the one the model is surest of stays, then the one that begins first.
    """
    jobs = [(d, start) for d, text in enumerate(texts) for start in _windows(text)]
    found: dict[int, list[tuple[float, int, int, int]]] = {}
    cache: tuple[int, np.ndarray] = (-1, np.zeros(0, np.int64))
    for at in range(0, len(jobs), at_once):
        some, rows = jobs[at : at + at_once], []
        for d, start in some:
            if cache[0] != d:
                cache = (d, _codes(texts[d]))
            part = cache[1][start : start + WINDOW]
            rows.append(np.append(part, np.full(WINDOW - len(part), _N_CHARS - 1)))
        tags, margins = decoded(net, np.stack(rows))
        for (d, start), tag, margin in zip(some, tags, margins):
            i = 0
            while i < WINDOW:
                if not tag[i]:
                    i += 1
                    continue
                j = i + 1
                kind = (tag[i] - 1) // 2
                while j < WINDOW and tag[j] == 2 + 2 * kind:
                    j += 1
                cut = (i == 0 and start > 0) or (j == WINDOW and start + WINDOW < len(texts[d]))
                if not cut and start + j <= len(texts[d]):
                    found.setdefault(d, []).append((-float(margin[i:j].mean()), start + i, start + j, int(kind)))
                i = j
    out: list[list[Span]] = [[] for _ in texts]
    for d, spans in found.items():
        taken: list[Span] = []
        for _, a, b, kind in sorted(set(spans)):
            if all(b <= x or y <= a for _, x, y in taken) and admissible(kind, texts[d][a:b]):
                taken.append((kind, a, b))
        out[d] = taken
    return out


def spans_of(texts: list[str | None], net: Network) -> tuple[list[list[Span]], list[list[Span]]]:
    """(spans of the patterns, all spans) of each text, by kind, then start."""
    whole = [t or "" for t in texts]
    base = [base_spans(t) for t in whole]
    every = []
    for own, more in zip(base, model_spans(whole, net)):
        fixed = sorted((a, b) for _, a, b in own)
        starts = [a for a, _ in fixed]
        # Spans of the patterns may overlap; the furthest end so far tells whether one reaches a place.
        reach = np.maximum.accumulate([b for _, b in fixed]) if fixed else np.zeros(0, np.int64)
        free = [s for s in more if not (n := np.searchsorted(starts, s[2])) or reach[n - 1] <= s[1]]
        every.append(sorted([*own, *free]))
    return base, every


def _text_of(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    texts = sorted(t for batch in batches for t in batch.column("text").to_pylist())
    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([w.ravel() for w in fit(texts)]).tobytes()], pa.binary())], names=["weights"])


def train(docs: DataFrame) -> Network:
    """Learns in one task from at most about SAMPLE_ROWS documents with a digit or an @."""
    net = _fresh()
    some = docs.where(F.col("text").rlike("[@0-9]"))
    share = min(1.0, SAMPLE_ROWS / max(1, some.count()))
    sample = some.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long"), "text"), F.lit(1_000_000)) < share * 1_000_000).select("text")
    row = sample.repartition(1).mapInArrow(_trained, "weights binary").collect()
    if not row:
        return net
    flat, out, at = np.frombuffer(row[0][0]), [], 0
    for w in net:
        out.append(flat[at : at + w.size].reshape(w.shape))
        at += w.size
    return Network(*out)


def find(docs: DataFrame, net: Network) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added), one row per input row.

    The counts and base_sha256 are those of the patterns; `spans` also has the n_added spans of the model. A NULL text is
    an empty one; it has no spans. Other columns are not read; an empty table gives an empty one.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                base, every = spans_of(part.column("text").to_pylist(), shared.value)
                counts = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, pa.array([hashlib.sha256(_text_of(b).encode()).hexdigest() for b in base], pa.string()),
                     pa.array([_text_of(e) for e in every], pa.string()), pa.array([len(e) - len(b) for b, e in zip(base, every)], pa.int64())],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"],
                )

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(found, schema)


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans are one, named by the first."""
    out, done = [], 0
    for a, b, kind in sorted((a, b, k) for k, a, b in spans):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def redact(docs: DataFrame, net: Network) -> DataFrame:
    """`docs` with all personal data in `text` replaced by its kind in brackets, and n_chars, where it is, counted anew."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = part.column("text").to_pylist()
                _, every = spans_of(texts, shared.value)
                new = [masked(t, s) if s else t for t, s in zip(texts, every)]
                part = part.set_column(part.schema.get_field_index("text"), part.schema.field("text"), pa.array(new, part.schema.field("text").type))
                at = part.schema.get_field_index("n_chars")
                if at >= 0:
                    field = part.schema.field(at)
                    sizes = [len(t) if s else n for t, s, n in zip(new, every, part.column(at).to_pylist())]
                    part = part.set_column(at, field, pa.array(sizes, field.type))
                yield part

    return docs.mapInArrow(redacted, docs.schema)
