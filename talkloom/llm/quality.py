"""Quality classifier by co-training of two views.

One logistic regression sees the text's content (pairs of neighbouring
character classes, repetition of words and lines), another only the page's
metadata (source, language, length).  Over some rounds each labels the
unlabelled documents it is surest of, as many of each class as the labelled
sample's shares ask for, and hands them to the other.  Both are then calibrated
on a fold that neither was trained on, and their calibrated log-odds are
combined by weights from a third fold that neither training nor calibration
saw, so a view that knows nothing weighs nothing.

Training takes a bounded sample of labelled rows and of unlabelled ones
(``MAX_LABELLED``, ``MAX_POOL``); scoring covers all documents whole.

Defined cases: null text counts as empty, null metadata as values of their own;
of labels that repeat a document the mean counts, at 0.5 and more as good; with
fewer than 20 labels, or with a fold (to train, to calibrate, to combine) that
lacks a class, there is nothing to learn from: every score is 0.5 and nothing is
rejected; an empty table gives an empty result; of equal scores at the threshold
all are accepted; repeated rows score alike; very long texts are read whole, one
at a time.  Columns other than the named ones pass through untouched; a result
column whose name one of them bears gets a trailing underscore.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_names, lean, shared_folder, stored, words_of

#: Bounds of the training samples.
MAX_LABELLED = 4_000
MAX_POOL = 4_000
ROUNDS = 3
#: Share of the pool that a view labels in a round.
SURE = 0.05
#: Score below which a document is rejected.
THRESHOLD = 0.4
META_BUCKETS = 64

_CLASS = np.full(256, 15, np.uint16)  # bytes of multi-byte characters
for _i, _chars in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n\r", b".,;:", b"!?", b"'\"`", b"()[]{}", b"#$%&*", b"|\\/", b"<>=+~^", b"-_", b"@")
):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _i
_CLASS[np.setdiff1d(np.arange(128), np.flatnonzero(_CLASS < 15))] = 14


def text_features(raw: bytes | None) -> np.ndarray:
    """Shares of character classes and of neighbouring ones, and measures of repetition."""
    out = np.zeros(256 + 16 + 7, np.float32)
    if not raw:
        out[278] = 1
        return out
    c = _CLASS[np.frombuffer(raw, np.uint8)]
    out[256:272] = np.sqrt(np.bincount(c, minlength=16) / len(c))
    if len(c) > 1:
        out[:256] = np.sqrt(np.bincount(c[:-1] * 16 + c[1:], minlength=256) / (len(c) - 1))
    words = words_of(raw)
    lines = [x for x in raw.split(b"\n") if x]
    if words:
        out[272] = len(set(words)) / len(words)
        out[273] = sum(map(bytes.__eq__, words, words[1:])) / len(words)
        out[274] = min(20.0, sum(map(len, words)) / len(words)) / 20
    out[275] = len(set(lines)) / len(lines) if lines else 0
    out[276] = min(1.0, len(lines) / (1 + len(words)) * 5)
    out[277] = np.log1p(len(words)) / 12
    return out


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    out = np.zeros(2 * META_BUCKETS + 17, np.float32)
    out[zlib.crc32(repr(source).encode()) % META_BUCKETS] = 1
    out[META_BUCKETS + zlib.crc32(repr(lang).encode()) % META_BUCKETS] = 1
    out[2 * META_BUCKETS + (16 if n_chars is None or n_chars < 0 else min(15, int(np.log2(1 + n_chars))))] = 1
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Linear:
    """Logistic regression over standardised features."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.weights + self.bias


def train_linear(x: np.ndarray, y: np.ndarray, ridge: float = 30.0, steps: int = 12) -> Linear:
    """Ridge-penalised fit by iteratively reweighted least squares."""
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale < 1e-3, 1.0, scale)
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1).astype(np.float64)
    penalty = np.append(np.full(x.shape[1], ridge), 1e-6)
    weights = np.zeros(z.shape[1])
    for _ in range(steps):
        p = sigmoid(z @ weights)
        curve = np.maximum(p * (1 - p), 1e-4)
        step = np.linalg.solve((z * curve[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * weights)
        weights += step
        if np.abs(step).max() < 1e-4:
            break
    return Linear(mean, scale, weights[:-1], float(weights[-1]))


def calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make logits into probabilities (Platt's method)."""
    fit = train_linear(logits[:, None], y, ridge=0.1)
    slope = float(fit.weights[0] / fit.scale[0])
    return slope, float(fit.bias - slope * fit.mean[0])


@dataclass
class Model:
    text: Linear | None
    meta: Linear | None
    text_scale: tuple[float, float] = (1.0, 0.0)
    meta_scale: tuple[float, float] = (1.0, 0.0)
    combined: Linear | None = None

    def scores(self, text_x: np.ndarray, meta_x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of good quality: by text, by metadata, by both."""
        if self.combined is None:
            half = np.full(len(text_x), 0.5)
            return half, half, half
        both = self.calibrated(text_x, meta_x)
        return sigmoid(both[:, 0]), sigmoid(both[:, 1]), sigmoid(self.combined.logits(both))

    def calibrated(self, text_x: np.ndarray, meta_x: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of both views (rows x 2)."""
        a = self.text.logits(text_x) * self.text_scale[0] + self.text_scale[1]
        b = self.meta.logits(meta_x) * self.meta_scale[0] + self.meta_scale[1]
        return np.stack([a, b], axis=1)


def co_train(text_x: np.ndarray, meta_x: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray) -> Model:
    turn = np.arange(len(y)) % 5
    learn, scale, join = turn < 3, turn == 3, turn == 4  # to train on, to calibrate on, to combine on
    if len(y) < 20 or any(len(set(y[fold])) < 2 for fold in (learn, scale, join)):
        return Model(None, None)
    views = {"text": (text_x[learn], pool_text), "meta": (meta_x[learn], pool_meta)}
    # what each view is trained on beside the labelled rows: places in the pool and their labels
    given: dict[str, dict[int, float]] = {"text": {}, "meta": {}}
    models: dict[str, Linear] = {}
    share = float(y[learn].mean())
    for k in range(ROUNDS + 1):
        for name, (x, pool) in views.items():
            places = np.fromiter(given[name], int)
            labels = np.fromiter(given[name].values(), float)
            models[name] = train_linear(np.concatenate([x, pool[places]]), np.concatenate([y[learn], labels]))
        if k == ROUNDS or not len(pool_text):
            break
        for name, other in (("text", "meta"), ("meta", "text")):
            logits = models[name].logits(views[name][1])
            order = np.argsort(logits, kind="stable")
            n = max(1, int(SURE * len(order)))
            good, bad = max(1, int(n * share)), max(1, int(n * (1 - share)))
            known = models[name].logits(views[name][0])
            # sure is: beyond the middle of what the labelled rows of that class get
            low, high = np.median(known[y[learn] == 0]), np.median(known[y[learn] == 1])
            given[other].update({int(i): 1.0 for i in order[-good:] if logits[i] >= high and high > low})
            given[other].update({int(i): 0.0 for i in order[:bad] if logits[i] <= low and high > low})
    model = Model(models["text"], models["meta"])
    model.text_scale = calibrate(model.text.logits(text_x[scale]), y[scale])
    model.meta_scale = calibrate(model.meta.logits(meta_x[scale]), y[scale])
    model.combined = train_linear(model.calibrated(text_x[join], meta_x[join]), y[join], ridge=0.1)
    return model


FEATURES = ("f_text", "f_source", "f_lang", "f_chars")


def _features(batch: pa.RecordBatch, lo: int, n: int, names: tuple[str, ...] = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    piece = batch.slice(lo, n)
    texts = piece.column(names[0]).cast(pa.binary()).to_pylist()
    meta = zip(*(piece.column(c).to_pylist() for c in names[1:]), strict=True)
    return np.stack([text_features(t) for t in texts]), np.stack([meta_features(*m) for m in meta])


def _inputs(text_col: str, source_col: str, lang_col: str, chars_col: str) -> list[F.Column]:
    return [
        F.col(text_col).alias("f_text"),
        F.col(source_col).cast("string").alias("f_source"),
        F.col(lang_col).cast("string").alias("f_lang"),
        F.col(chars_col).cast("long").alias("f_chars"),
    ]


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    lang_col: str = "lang", chars_col: str = "n_chars", label_col: str = "quality",
) -> Model:
    """Train on bounded samples: the rows whose ids hash lowest.

    Rows without an id are told apart by their texts.  However often an id
    repeats, at most MAX_LABELLED labelled rows and twice MAX_POOL others, those
    whose ids and features hash lowest, come to the driver, as features.
    """
    turn = F.when(F.col(id_col).isNull(), F.xxhash64(text_col)).otherwise(F.xxhash64(F.col(id_col)))
    marked = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("s_id"))
        .agg((F.avg(label_col) >= 0.5).cast("double").alias("y"))
        .orderBy(F.xxhash64("s_id"))
        .limit(MAX_LABELLED)
    )
    n_docs = docs.count()
    in_pool = F.pmod(turn, F.lit(1_000_000)) < int(1_000_000 * min(1.0, MAX_POOL / max(1, n_docs)))
    rows = docs.select(F.col(id_col).alias("id"), in_pool.alias("pool"), *_inputs(text_col, source_col, lang_col, chars_col))
    # the labelled sample has at most MAX_LABELLED narrow rows
    sample = rows.join(F.broadcast(marked), rows["id"] == marked["s_id"], "left").where("pool or y is not null")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                text_x, meta_x = _features(batch, lo, 256)
                piece = batch.slice(lo, 256)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id").cast(pa.string()), piece.column("y"),
                     pa.array([r.tobytes() for r in text_x], pa.binary()), pa.array([r.tobytes() for r in meta_x], pa.binary())],
                    names=["id", "y", "text_x", "meta_x"],
                )

    got = sample.select("id", "y", "f_text", "f_source", "f_lang", "f_chars").mapInArrow(
        run, "id string, y double, text_x binary, meta_x binary"
    )
    kept = stored(got, f"{shared_folder(docs.sparkSession)}/sample")
    low = F.xxhash64("id", "text_x", "meta_x")
    bounded = kept.where("y is not null").orderBy(low).limit(MAX_LABELLED).union(kept.where("y is null").orderBy(low).limit(2 * MAX_POOL))
    found = sorted(bounded.collect(), key=lambda r: (zlib.crc32(str(r["id"]).encode()), str(r["id"]), r["text_x"]))

    def matrix(rows: list, name: str, width: int) -> np.ndarray:
        return np.stack([np.frombuffer(r[name], np.float32) for r in rows]) if rows else np.zeros((0, width), np.float32)

    known, pool = [r for r in found if r["y"] is not None], [r for r in found if r["y"] is None]
    widths = len(text_features(None)), len(meta_features(None, None, None))
    return co_train(
        matrix(known, "text_x", widths[0]), matrix(known, "meta_x", widths[1]), np.array([r["y"] for r in known]),
        matrix(pool, "text_x", widths[0]), matrix(pool, "meta_x", widths[1]),
    )


RESULTS = ["text_score", "meta_score", "score", "accepted"]


def score(
    docs: DataFrame, model: Model, text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
    chars_col: str = "n_chars", threshold: float = THRESHOLD, keep: list[str] | None = None,
) -> DataFrame:
    """The kept columns of every document with the columns of RESULTS.

    A map over the scan, without a shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.columns if keep is None else keep
    # a column that is kept goes to the workers once
    inputs = dict(zip(FEATURES, zip((text_col, source_col, lang_col, chars_col), ("string", "string", "string", "bigint"), strict=True), strict=True))
    own = {f: f"k_{c}" if c in kept and docs.schema[c].dataType.simpleString() == kind else f for f, (c, kind) in inputs.items()}
    more = [x for f, x in zip(FEATURES, _inputs(text_col, source_col, lang_col, chars_col), strict=True) if own[f] == f]
    source = docs.select(*(F.col(c).alias(f"k_{c}") for c in kept), *more)
    features = tuple(own.values())
    results = free_names(kept, RESULTS)
    kinds = [source.schema[f"k_{c}"].dataType.simpleString() for c in kept] + ["double"] * 3 + ["boolean"]
    schema = ", ".join(f"`{c}` {kind}" for c, kind in zip([*kept, *results], kinds, strict=True))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                text, meta, both = shared.value.scores(*_features(batch, lo, 256, features))
                piece = batch.slice(lo, 256)
                yield pa.RecordBatch.from_arrays(
                    [*(piece.column(f"k_{c}") for c in kept), *(pa.array(x, pa.float64()) for x in (text, meta, both)),
                     pa.array(both >= threshold, pa.bool_())],
                    names=[*kept, *results],
                )

    return source.mapInArrow(run, schema)
