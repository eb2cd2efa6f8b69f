"""Toxicity: a linear-chain conditional random field over words.

Fitting uses a bounded sample of labelled rows (``sample_rows``, half of them
toxic where there are as many):

1. Spark counts word beginnings over the sample's toxic and clean texts; those
   that a likelihood-ratio test ties to toxic texts label the words of toxic
   texts as toxic, all other words as clean.
2. The field (two states, features of the word and its neighbours) is trained
   on windows of labelled words by Adagrad on the conditional likelihood.
3. A logistic curve turns the forward-backward marginals of a whole text into
   its score; its base rate is that of all training labels.

Scoring tags every word of every text: the marginals give the spans, and their
sum and maximum the score. Texts never move; the sample's ids and the weights
are broadcast and bounded by parameters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import in_batches, utf8_values
from tidepool.session import materialize

SAMPLE_ROWS = 16_000
WINDOWS = 24_000
WINDOW = 40
DIMS = 1 << 18
MARKERS = 4_000
THRESHOLD = 0.3

# Word beginnings (with the end marked) that serve as features and markers.
BEGINNINGS = (3, 4, 5, 6, 7)
MARKING = (4, 5, 6, 7)

WORDS = re.compile(rb"[a-z0-9\x80-\xff]+")
CACHE_WORDS = 200_000
BLOCK_WORDS = 1 << 18
LIMIT = 30.0


def text_words(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, so that byte offsets are those of the text."""
    return WORDS.findall(bytes(text).lower())


def beginnings(word: bytes, sizes: tuple[int, ...]) -> set[bytes]:
    marked = word + b"$"
    return {marked[:k] for k in sizes if k <= len(marked)} or {marked}


def features(word: bytes) -> list[int]:
    own = [zlib.crc32(b"p" + b) % DIMS for b in beginnings(word, BEGINNINGS)]
    return [*own, zlib.crc32(b"w" + word) % DIMS, zlib.crc32(b"s" + word[-3:]) % DIMS]


def neighbour(word: bytes, side: bytes) -> int:
    return zlib.crc32(side + word[:5]) % DIMS


# ---- the field --------------------------------------------------------------

def messages(emit: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, ...]:
    """Forward and backward messages, as odds of state 1, and the odds of the features.

    ``emit`` holds the sequences one after another: the log odds that the
    features give. A message of a two-state chain is one number; the
    sequences go step by step together, the longest first.
    """
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    sorted_lengths = lengths[order]
    steps = int(sorted_lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-sorted_lengths, -np.arange(steps), side="left") if steps else []
    (a00, a01), (a10, a11) = np.exp(moves)
    odds = np.exp(np.clip(emit, -LIMIT, LIMIT))
    ahead, back = np.empty(len(emit)), np.empty(len(emit))
    r = None
    for t in range(steps):
        at = starts[:active[t]] + t
        r = odds[at] if t == 0 else odds[at] * (a01 + a11 * r[:active[t]]) / (a00 + a10 * r[:active[t]])
        np.clip(r, 1e-13, 1e13, out=r)
        ahead[at] = r
    b = np.ones(0)
    for t in range(steps - 1, -1, -1):
        n, seen = active[t], len(b)
        at = starts[:n] + t
        now = np.ones(n)
        if seen:
            later = odds[at[:seen] + 1] * b
            now[:seen] = (a10 + a11 * later) / (a00 + a01 * later)
        back[at] = b = now
    return ahead, back, odds


def log_ratios(emit: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Log odds of state 1 at each place, given the whole sequence it is part of."""
    ahead, back, _ = messages(emit, moves, lengths)
    return np.log(ahead) + np.log(back)


@dataclass
class Field:
    """Weights of hashed features and of the moves between states, and the score's curve."""

    weights: np.ndarray
    moves: np.ndarray
    curve: np.ndarray

    def score(self, summary: np.ndarray) -> np.ndarray:
        z = np.clip(np.column_stack([np.ones(len(summary)), summary]) @ self.curve, -40, 40)
        return 1 / (1 + np.exp(-z))


class Tagger:
    """Marginals of whole texts; the weights of a word are summed once."""

    def __init__(self, field: Field):
        self.field = field
        self._forget()

    def _forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.table = np.zeros((3, 1024))

    def _row(self, word: bytes) -> int:
        k = self.index[word] = len(self.index)
        if k == self.table.shape[1]:
            self.table = np.concatenate([self.table, np.zeros_like(self.table)], axis=1)
        w = self.field.weights
        self.table[:, k] = w[features(word)].sum(), w[neighbour(word, b"<")], w[neighbour(word, b">")]
        return k

    def emissions(self, words: list[bytes]) -> np.ndarray:
        if len(self.index) > CACHE_WORDS:
            self._forget()
        get, row = self.index.get, self._row
        at = np.fromiter((k if (k := get(w)) is not None else row(w) for w in words), np.int64, len(words))
        own, before, after = self.table
        out = own[at]
        out[1:] += before[at[:-1]]
        out[:-1] += after[at[1:]]
        return out

    def tag(self, texts: list[list[bytes]]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Per text a summary and the marginals of its words.

        The summary is the log of the expected number of offending words
        (marginals of one half or more, so that many words of tiny marginals
        do not add up in a long text), the best log odds and the log length.
        """
        lengths = np.array([len(t) for t in texts], np.int64)
        emit = np.concatenate([self.emissions(t) for t in texts] or [np.zeros(0)])
        logit = log_ratios(emit, self.field.moves, lengths)
        p = 1 / (1 + np.exp(-np.clip(logit, -LIMIT, LIMIT)))
        ends = np.cumsum(lengths)
        parts = [slice(e - n, e) for e, n in zip(ends, lengths, strict=True)]
        summary = np.array([[np.log(p[s][p[s] >= 0.5].sum() + 0.1), np.clip(logit[s].max(), -LIMIT, LIMIT) / 10,
                             np.log1p(s.stop - s.start)] if s.stop > s.start
                            else [np.log(0.1), -LIMIT / 10, 0.0] for s in parts]).reshape(-1, 3)
        return summary, [p[s] for s in parts]


def blocks(batch: pa.RecordBatch, text_column: int) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Runs of rows of a batch with about BLOCK_WORDS words, as (first row, their words)."""
    first, kept, words = 0, [], 0
    for i, text in enumerate(utf8_values(batch.column(text_column))):
        kept.append(text_words(text))
        words += len(kept[-1])
        if words >= BLOCK_WORDS:
            yield first, kept
            first, kept, words = i + 1, [], 0
    if kept:
        yield first, kept


# ---- fitting ----------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                    sample_rows: int) -> tuple[DataFrame, int, int]:
    """Checkpointed ``text, label`` of at most ``sample_rows`` rows, and all labels' counts."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .groupBy(id_col).agg(F.max(F.col(label_col).cast("int")).alias("_label")))
    known = materialize(known)
    counts = dict(known.groupBy("_label").count().collect())
    half = sample_rows // 2
    picks = [known.where(F.col("_label") == y).orderBy(F.xxhash64(id_col), id_col).limit(half) for y in (0, 1)]
    picked = picks[0].unionAll(picks[1])  # sample_rows rows of an id and a label at most
    text = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text"))
    sample = text.join(F.broadcast(picked), id_col).select("_text", "_label")
    return materialize(sample), counts.get(1, 0), counts.get(0, 0)


def toxic_markers(sample: DataFrame) -> set[bytes]:
    """Word beginnings tied to toxic texts beyond chance, MARKERS at most."""
    schema = pa.schema([("mark", pa.binary()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(utf8_values(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                marks = set()
                for word in set(text_words(text)):
                    marks |= beginnings(word, MARKING)
                counts[y].update(marks)
        clean, toxic = counts
        yield from in_batches(((m, toxic[m], clean[m]) for m in toxic.keys() | clean.keys()), schema)

    rows = sample.mapInArrow(run, "mark binary, toxic bigint, clean bigint")
    rows = materialize(rows.groupBy("mark").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c")))
    sizes = dict(sample.groupBy("_label").count().collect())
    nt, nc = sizes.get(1, 0), sizes.get(0, 0)
    kinds = rows.count()
    if not nt or not nc:
        return set()
    t, c = F.col("t"), F.col("c")
    share = (t + c) / F.lit(nt + nc)
    chance = t * F.log((t + 1e-9) / (nt * share)) + c * F.log((c + 1e-9) / (nc * share))
    odds = ((t + 0.5) / (nt + 1)) / ((c + 0.5) / (nc + 1))
    marked = (rows.withColumn("g", chance).where((odds > 8) & (F.col("g") > float(np.log(max(kinds, 2)))))
              .orderBy(F.desc("g"), "mark").limit(MARKERS))
    return {bytes(r.mark) for r in marked.select("mark").collect()}


def training_windows(sample: DataFrame, markers: set[bytes], size: int,
                     most: int = 2 * SAMPLE_ROWS) -> list[tuple[list[bytes], list[int]]]:
    """At most ``most`` windows of words with their labels: around toxic words, and spread ones.

    If a sample makes more, those of the least hashes stay, from wherever in the table.
    """
    rows = max(1, sample.count())
    each = max(1, min(WINDOWS, most) // (2 * rows))
    schema = pa.schema([("words", pa.binary()), ("labels", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut():
            for batch in batches:
                for text, y in zip(utf8_values(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                    words = text_words(text)
                    hot = [int(bool(y) and not markers.isdisjoint(beginnings(w, MARKING))) for w in words]
                    hits = [i for i, h in enumerate(hot) if h]
                    centres = hits[::max(1, len(hits) // each)][:each]
                    centres += [(2 * k + 1) * len(words) // (2 * each) for k in range(each)]
                    for at in dict.fromkeys(max(0, i - size // 2) for i in centres):
                        if words[at:at + size]:
                            yield b" ".join(words[at:at + size]), bytes(hot[at:at + size])

        yield from in_batches(cut(), schema, 2000)

    found = sample.mapInArrow(run, "words binary, labels binary")
    chosen = found.orderBy(F.xxhash64("words", "labels"), "words", "labels").limit(most).collect()
    known: dict[bytes, bytes] = {}  # equal words are one object
    return [([known.setdefault(w, w) for w in bytes(r.words).split(b" ")], list(bytes(r.labels))) for r in chosen]


def train_field(windows: list[tuple[list[bytes], list[int]]], epochs: int = 8, batch: int = 512,
                rate: float = 0.3, decay: float = 1e-5, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Weights and moves that fit the labels: Adagrad on the conditional log-likelihood."""
    weights, moves = np.zeros(DIMS), np.zeros((2, 2))
    grads, move_grads = np.full(DIMS, 1e-2), np.full((2, 2), 1e-2)
    known: dict[bytes, list[int]] = {}
    encoded = []
    for words, labels in windows:
        rows = []
        for i, w in enumerate(words):
            if w not in known:
                known[w] = features(w)
            own = known[w]
            near = [neighbour(words[i - 1], b"<")] if i else []
            near += [neighbour(words[i + 1], b">")] if i + 1 < len(words) else []
            rows.append((own, near))
        flat = np.array([f for own, near in rows for f in (*own, *near)], np.int32)
        encoded.append((flat, np.array([len(o) + len(n) for o, n in rows], np.int32), np.array(labels, np.int8)))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        order = rng.permutation(len(encoded))
        for k in range(0, len(order), batch):
            part = [encoded[i] for i in order[k:k + batch]]
            flat = np.concatenate([p[0] for p in part])
            owner = np.repeat(np.arange(sum(len(p[1]) for p in part)), np.concatenate([p[1] for p in part]))
            gold = np.concatenate([p[2] for p in part]).astype(np.int64)
            lengths = np.array([len(p[2]) for p in part])
            emit = np.bincount(owner, weights[flat], len(gold))
            ahead, back, odds = messages(emit, moves, lengths)
            p = 1 / (1 + 1 / np.clip(ahead * back, 1e-13, 1e13))
            g = np.bincount(flat, (gold - p)[owner], DIMS) / len(gold) * 50 - decay * weights
            grads += g * g
            weights += rate * g / np.sqrt(grads)
            mg = _move_gradient(ahead, odds * back, moves, lengths, gold) / len(gold) * 50 - decay * moves
            move_grads += mg * mg
            moves += rate * mg / np.sqrt(move_grads)
    return weights, moves


def _move_gradient(ahead, later, moves, lengths, gold) -> np.ndarray:
    """Observed less expected moves; ``later`` is the odds from a place on to the end."""
    inner = np.ones(len(gold), bool)
    inner[np.cumsum(lengths)[lengths > 0] - 1] = False
    i = np.flatnonzero(inner)
    one = np.ones(len(i))
    joint = (np.stack([one, ahead[i]])[:, None] * np.exp(moves)[:, :, None]
             * np.stack([one, later[i + 1]])[None, :])
    joint /= joint.sum(axis=(0, 1))
    seen = np.bincount(2 * gold[i] + gold[i + 1], minlength=4).reshape(2, 2)
    return seen - joint.sum(axis=2)


def fit_curve(summary: np.ndarray, y: np.ndarray, base_odds: float, ridge: float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the intercept is moved to ``base_odds``."""
    x = np.column_stack([np.ones(len(summary)), summary])
    beta, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[ridge] * summary.shape[1]])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -LIMIT, LIMIT)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(beta)),
                               x.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -5, 5)
    beta[0] += np.log(base_odds) - np.log(max(y.sum(), 0.5) / max((1 - y).sum(), 0.5))
    return beta


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS, windows: int | None = None) -> Field:
    """The field and curve learnt from ``labels`` (one 0/1 label per id; larger of several).

    ``windows`` bounds the training windows; without it there is room for
    WINDOWS, and for two of every sample row in any case.

    Ids or labels that are null are left out. Without labels of both kinds
    the scores of all texts are the base rate of the labels there are, or 0.5.
    """
    sample, toxic, clean = labelled_sample(docs, labels, id_col, text_col, label_col, sample_rows)
    base = (toxic + 0.5) / (clean + 0.5)
    markers = toxic_markers(sample)
    if not markers:
        return Field(np.zeros(DIMS), np.zeros((2, 2)), np.array([np.log(base), 0, 0, 0]))
    most = max(WINDOWS, 2 * sample_rows) if windows is None else windows
    weights, moves = train_field(training_windows(sample, markers, WINDOW, most))
    field = Field(weights.astype(np.float32), moves, np.zeros(4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field)
        for batch in batches:
            y = batch.column(1).to_pylist()
            for first, texts in blocks(batch, 0):
                summary, _ = tagger.tag(texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(summary[:, j]) for j in range(3)] + [pa.array(y[first:first + len(texts)], pa.int32())],
                    names=["a", "b", "c", "y"])

    rows = np.array(sample.mapInArrow(run, "a double, b double, c double, y int").collect(), float)
    field.curve = fit_curve(rows[:, :3], rows[:, 3], base)
    return field


# ---- scoring ----------------------------------------------------------------

def score_toxicity(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD, spans: bool = True,
                   keep: list[str] | None = None) -> DataFrame:
    """Per row ``id_col, score, predicted`` and the offending ``spans`` of its text.

    A span is (start, end, probability): byte offsets in the UTF-8 text of a
    word that the field marks as toxic with at least one half. Defined cases:
    a null text is an empty one, which has no words and the score the curve
    gives to none; repeated rows are scored once each; a null id stays null;
    an empty table gives an empty result; ``keep`` names input columns to
    pass on, others are ignored.
    """
    keep = keep or []
    # A text that is kept is sent to the tasks once.
    once = text_col in keep and docs.schema[text_col].dataType.simpleString() == "string"
    at = 1 + keep.index(text_col) if once else 0
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field)
        for batch in batches:
            values = list(utf8_values(batch.column(at))) if spans else None
            for first, texts in blocks(batch, at):
                summary, marginals = tagger.tag(texts)
                score = field.score(summary)
                cols = [*batch.slice(first, len(texts)).columns[0 if once else 1:], pa.array(score),
                        pa.array((score >= threshold).astype(np.int32))]
                if spans:
                    cols.append(pa.array([_spans(values[first + i], p) for i, p in enumerate(marginals)], span_type))
                yield pa.RecordBatch.from_arrays(cols, names=out_names)

    chosen = [docs[id_col].alias("_id"), *[docs[c].alias(f"_keep_{c}") for c in keep]]
    out_names = ["_id", *[f"_keep_{c}" for c in keep], "score", "predicted", *(["spans"] if spans else [])]
    types = [f"_id {docs.schema[id_col].dataType.simpleString()}",
             *[f"`_keep_{c}` {docs.schema[c].dataType.simpleString()}" for c in keep],
             "score double, predicted int"]
    if spans:
        types.append("spans array<struct<start: bigint, end: bigint, probability: double>>")
    text = [] if once else [F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text")]
    out = docs.select(*text, *chosen)
    return out.mapInArrow(run, ", ".join(types)).toDF(
        id_col, *keep, "score", "predicted", *(["spans"] if spans else []))


def _spans(text: memoryview, p: np.ndarray) -> list[dict]:
    hot = np.flatnonzero(p >= 0.5)
    if not len(hot):
        return []
    places = [m.span() for m in WORDS.finditer(bytes(text).lower())]
    return [{"start": places[i][0], "end": places[i][1], "probability": float(p[i])} for i in hot]
